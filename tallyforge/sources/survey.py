"""The health-survey CSV: schema and column roles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

# The survey's columns by role.
SURVEY_NUMERIC = ["BMI", "PhysicalHealth", "MentalHealth", "SleepTime"]
SURVEY_YES_NO_LABEL = "HeartDisease"
SURVEY_AGE_LABEL = "AgeCategory"
# The survey's columns in file order.
SURVEY_COLUMNS = [
    "HeartDisease", "BMI", "Smoking", "AlcoholDrinking", "Stroke", "PhysicalHealth",
    "MentalHealth", "DiffWalking", "Sex", "AgeCategory", "Race", "Diabetic",
    "PhysicalActivity", "GenHealth", "SleepTime", "Asthma", "KidneyDisease", "SkinCancer",
]
SURVEY_SCHEMA = T.StructType(
    [
        T.StructField(c, T.DoubleType() if c in SURVEY_NUMERIC else T.StringType())
        for c in SURVEY_COLUMNS
    ]
)


def survey_categorical(label: str) -> list[str]:
    """The categorical features when ``label`` is the target: the rest of the text columns."""
    texts = [c for c in SURVEY_COLUMNS if c not in SURVEY_NUMERIC]
    return [c for c in texts if c != label]


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = SURVEY_SCHEMA
) -> DataFrame:
    """CSV with a header; ``schema=None`` infers the types with an extra pass."""
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)
