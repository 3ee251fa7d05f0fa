"""Feature preparation: encodings, ML stages and the readings of fitted stages."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.ml.feature import (
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
    VectorIndexer,
    VectorIndexerModel,
)
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyforge.functions.scalar import cyclical

# The two feature lists of the temperature models.
LINEAR_FEATURES = [
    "year", "day", "latitude", "longitude", "elevationDimension", "directionAngle", "speedRate",
    "ceilingHeightDimension", "distanceDimension", "dewPointTemperature",
    "month_sin", "month_cos", "hour_sin", "hour_cos",
]
FOREST_FEATURES = [
    "year", "month", "day", "hour", "latitude", "longitude", "elevationDimension",
    "directionAngle", "speedRate", "ceilingHeightDimension", "distanceDimension",
    "dewPointTemperature",
]
# The lengths of the cycles.
CYCLES = {"month": 12, "hour": 24}


def add_cyclical(df: DataFrame, cycles: dict[str, int] | None = None) -> DataFrame:
    """Add ``<name>_sin`` and ``<name>_cos`` for every cyclic column."""
    added = {}
    for name, period in (CYCLES if cycles is None else cycles).items():
        added[f"{name}_sin"], added[f"{name}_cos"] = cyclical(F.col(name), period)
    return df.withColumns(added)


def category_indexer(columns: list[str]) -> StringIndexer:
    """Features to indices, most frequent first; unseen and NULL get one extra index."""
    return StringIndexer(
        inputCols=columns, outputCols=[f"{c}_idx" for c in columns], handleInvalid="keep"
    )


def label_indexer(column: str, output: str = "label") -> StringIndexer:
    """Label to index; an unseen or NULL label is an error."""
    return StringIndexer(inputCol=column, outputCol=output, handleInvalid="error")


def tabular_stages(
    numeric: list[str], categorical: list[str], label: str, max_categories: int = 20
) -> list:
    """Indexers, assembler and vector indexer that produce ``features`` and ``label``.

    The vector indexer alone decides which features are categories: an indexed column
    keeps no note of its levels, so one with more than ``max_categories`` of them is a
    number to the trees and asks for no more bins than they have.
    """
    inputs = [*numeric, *[f"{c}_num" for c in categorical]]
    plain = ", ".join(f"`{c}_idx` + 0.0D AS `{c}_num`" for c in categorical)
    return [
        category_indexer(categorical),
        label_indexer(label),
        SQLTransformer(statement=f"SELECT *, {plain} FROM __THIS__" if categorical else "SELECT * FROM __THIS__"),
        VectorAssembler(inputCols=inputs, outputCol="rawFeatures", handleInvalid="keep"),
        VectorIndexer(
            inputCol="rawFeatures", outputCol="features",
            maxCategories=max_categories, handleInvalid="keep",
        ),
    ]


def scaled_stages(columns: list[str]) -> list:
    """Assembler and standard scaler (zero mean, unit sample deviation)."""
    return [
        VectorAssembler(inputCols=columns, outputCol="features_raw"),
        StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True),
    ]


def assembled_stages(columns: list[str]) -> list:
    """Assembler alone; a NULL feature is an error."""
    return [VectorAssembler(inputCols=columns, outputCol="features")]


def index_mapping(spark: SparkSession, model: StringIndexerModel) -> DataFrame:
    """Labels of a fitted indexer as ``(column, index, label)`` rows."""
    inputs = model.getInputCols() if model.isSet("inputCols") else [model.getInputCol()]
    rows = [
        (column, i, label)
        for column, labels in zip(inputs, model.labelsArray)
        for i, label in enumerate(labels)
    ]
    return spark.createDataFrame(rows, "column string, index int, label string")


def detected_categories(
    spark: SparkSession, model: VectorIndexerModel, names: list[str]
) -> DataFrame:
    """Categories a fitted vector indexer found, as ``(feature, value, index)`` rows."""
    rows = [
        (names[dim], float(value), int(index))
        for dim, categories in model.categoryMaps.items()
        for value, index in categories.items()
    ]
    return spark.createDataFrame(rows, "feature string, value double, index int")


def stage_of(model, kind: type) -> Transformer:
    """The first fitted stage of a kind."""
    return next(s for s in model.stages if isinstance(s, kind))
