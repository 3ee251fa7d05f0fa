"""Every operator as a query over the driver's tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import (
    StandardScaler,
    VectorAssembler,
    VectorIndexer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyforge.functions.scalar import rank_line
from tallyforge.operators import features, metrics, numbering, ranking, relational as rel, splits, tree_depths, tuning
from tallyforge.plans import fixtures as fx
from tallyforge.plans import model_queries, recommender, survey
from tallyforge.session import write_intermediate
from tallyforge.sources.delimited import read_alias, read_dimension, read_facts
from tallyforge.sources.fixed_width import read_fixed_width
from tallyforge.sources.survey import read_csv

Query = Callable[[SparkSession, str], DataFrame]


def _count_by(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


# --- sources -----------------------------------------------------------------


def parse_fixed_width_records(spark, sf_dir):
    return read_fixed_width(spark, fx.weather_files(spark, sf_dir)).good


def fixed_width_rejects(spark, sf_dir):
    return _count_by(read_fixed_width(spark, fx.weather_files(spark, sf_dir)).rejects, "reason")


def parse_dimension_lenient(spark, sf_dir):
    return read_dimension(spark, fx.dimension_files(spark, sf_dir)).good


def dimension_rejects(spark, sf_dir):
    return read_dimension(spark, fx.dimension_files(spark, sf_dir)).rejects


def parse_alias_lines(spark, sf_dir):
    return read_alias(spark, fx.alias_files(spark, sf_dir)).good


def parse_fact_lines(spark, sf_dir):
    return read_facts(spark, fx.fact_files(spark, sf_dir)).good


def fact_rejects(spark, sf_dir):
    return _count_by(read_facts(spark, fx.fact_files(spark, sf_dir)).rejects, "reason")


def survey_csv(spark, sf_dir):
    rows = read_csv(spark, fx.survey_files(spark, sf_dir))
    return rows.groupBy("HeartDisease", "Smoking", "AgeCategory", "Race", "Asthma").agg(
        F.count(F.lit(1)).alias("n"), F.sum("BMI").alias("bmi"), F.count("MentalHealth").alias("n_mental"),
        F.round(F.sum("SleepTime"), 4).alias("sleep"),
    )


def load_shape(spark, sf_dir):
    shapes = None
    for name in ("customer", "events", "lineitem", "orders", "part", "supplier"):
        rows = fx.table(spark, sf_dir, name)
        shape = rows.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(rows.columns)).alias("n_columns")
        )
        shapes = shape if shapes is None else shapes.unionByName(shape)
    return shapes


# --- relational --------------------------------------------------------------


def alias_resolve(spark, sf_dir):
    facts = fx.interactions(spark, sf_dir).withColumn("raw_item", F.col("item"))
    return rel.resolve_alias(facts, fx.aliases(spark, sf_dir))


def alias_merge(spark, sf_dir):
    return rel.merge_ratings(rel.resolve_alias(fx.interactions(spark, sf_dir), fx.aliases(spark, sf_dir)))


def name_lookup_default(spark, sf_dir):
    totals = rel.item_totals(fx.interactions(spark, sf_dir))
    return rel.with_names(totals, fx.part_names(spark, sf_dir))


def active_users(spark, sf_dir):
    return rel.active_users(fx.interactions(spark, sf_dir), fx.MIN_ITEMS)


def active_facts(spark, sf_dir):
    facts = fx.interactions(spark, sf_dir)
    return rel.keep_users(facts, rel.active_users(facts, fx.MIN_ITEMS))


def user_item_sets(spark, sf_dir):
    sets = rel.item_sets(fx.interactions(spark, sf_dir))
    return sets.select("user", "chunk", F.array_join(F.col("items").cast("array<string>"), ",").alias("items"))


def item_popularity(spark, sf_dir):
    return rel.item_totals(fx.interactions(spark, sf_dir))


def _top(spark, sf_dir):
    return rel.most_popular(fx.interactions(spark, sf_dir), fx.TOP)


def top_n_popular(spark, sf_dir):
    return _top(spark, sf_dir)


def top_n_report(spark, sf_dir):
    named = rel.with_names(_top(spark, sf_dir), fx.part_names(spark, sf_dir))
    line = rank_line(F.col("rank"), F.col("name"), F.col("item"), F.col("total"))
    return named.select("rank", line.alias("line"))


def exclude_rated(spark, sf_dir):
    facts = fx.stored_interactions(spark, sf_dir)
    top = rel.most_popular(facts, fx.TOP)
    return rel.exclude_pairs(ranking.same_list(facts.select("user").distinct(), top), facts)


def distinct_ids(spark, sf_dir):
    facts = fx.interactions(spark, sf_dir)
    found = rel.pairs(facts)
    return found.agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.countDistinct("user").alias("n_users"),
        F.countDistinct("item").alias("n_items"),
    )


def max_user(spark, sf_dir):
    return splits.next_user(fx.interactions(spark, sf_dir))


def synthetic_user(spark, sf_dir):
    return splits.synthetic_user(fx.interactions(spark, sf_dir))


def union_new_user(spark, sf_dir):
    data = model_queries.prepared(spark, sf_dir)
    return data.train.select("user", "item", "rating").unionByName(splits.synthetic_user(data.facts))


# --- splits ------------------------------------------------------------------


def hash_split(spark, sf_dir):
    return splits.hash_split(fx.table(spark, sf_dir, "lineitem").select(*fx.ROW_KEYS), fx.ROW_KEYS)


def temporal_holdout(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    return splits.temporal_split(orders, "year", (1995, 1999), 2000, 2001)


def per_user_split(spark, sf_dir):
    facts = fx.stored_interactions(spark, sf_dir)
    active = write_intermediate(rel.active_users(facts, fx.MIN_ITEMS), "active-users")
    sizes = active.select("user", F.col("n_rows").alias("_rows"))
    return splits.user_split(rel.keep_users(facts, active), fx.FACT_KEYS, sizes=sizes, repeated=False)


def kfold_assign(spark, sf_dir):
    return splits.assign_folds(fx.table(spark, sf_dir, "lineitem").select(*fx.ROW_KEYS), fx.ROW_KEYS)


def sample_ids(spark, sf_dir):
    return splits.sample_ids(fx.interactions(spark, sf_dir), "item", 8)


# --- features ----------------------------------------------------------------


def cyclical_encoding(spark, sf_dir):
    times = fx.weather_numbers(spark, sf_dir).select(*fx.ROW_KEYS, "month", "hour")
    added = features.add_cyclical(times)
    return fx.rounded(added, 9, "month_sin", "month_cos", "hour_sin", "hour_cos")


def string_index_keep(spark, sf_dir):
    part = fx.table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    known = part.filter("p_size <= 4 AND p_brand <> 'Brand#11' AND p_type <> 'PROMO'")
    fitted = features.category_indexer(["p_brand", "p_type"]).fit(known)
    return fitted.transform(part).select("p_partkey", "p_brand_idx", "p_type_idx")


def category_levels(spark, sf_dir):
    """The same as string_index_keep, from tables of levels."""
    part = fx.table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    known = part.filter("p_size <= 4 AND p_brand <> 'Brand#11' AND p_type <> 'PROMO'")
    for column in ("p_brand", "p_type"):
        part = numbering.index_by_table(part, column, numbering.category_table(known, column), f"{column}_idx")
    return part.select("p_partkey", "p_brand_idx", "p_type_idx")


def dense_ids(spark, sf_dir):
    """Numbers of ids beyond int and of text ids, back and forth."""
    orders = fx.table(spark, sf_dir, "orders")
    ids = orders.select(
        (F.col("o_custkey") * 10_000_000_000 - 5).alias("user"), F.concat_ws("/", "o_orderpriority", "o_custkey").alias("item")
    )
    users, items = numbering.dense_ids(ids, "user"), numbering.dense_ids(ids, "item")
    numbered = numbering.replace_ids(numbering.replace_ids(ids, users, "user"), items, "item")
    pairs = numbered.distinct().select("*", F.col("user").alias("user_number"), F.col("item").alias("item_number"))
    return numbering.original_ids(numbering.original_ids(pairs, users, "user"), items, "item")


def string_index_label(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders")
    fitted = features.label_indexer("o_orderpriority").fit(orders)
    counts = _count_by(fitted.transform(orders), "label")
    names = features.index_mapping(spark, fitted)
    return counts.join(names, counts.label.cast("int") == names["index"]).select(
        "index", names["label"].alias("priority"), "n"
    )


def assemble_vector(spark, sf_dir):
    lines = fx.table(spark, sf_dir, "lineitem").withColumn("gap", F.when(F.col("l_tax") > 0, F.col("l_tax")))
    inputs = ["l_quantity", "l_discount", "gap"]
    vectors = VectorAssembler(inputCols=inputs, outputCol="v", handleInvalid="keep").transform(lines)
    value = vector_to_array("v")
    return vectors.select(
        *fx.ROW_KEYS, *[F.nanvl(value[i], F.lit(-1.0)).alias(f"v{i}") for i in range(len(inputs))]
    )


def _category_inputs(spark, sf_dir):
    return fx.table(spark, sf_dir, "lineitem").select(
        *fx.ROW_KEYS, (F.col("l_linenumber") - 4).cast("double").alias("line"),
        F.col("l_quantity").alias("quantity"), F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"),
    )


def category_detect(spark, sf_dir):
    names = ["line", "quantity", "discount", "tax"]
    vectors = VectorAssembler(inputCols=names, outputCol="v").transform(_category_inputs(spark, sf_dir))
    fitted = VectorIndexer(inputCol="v", outputCol="f", maxCategories=20, handleInvalid="keep").fit(vectors)
    indexed = fitted.transform(vectors).select(
        F.inline(F.array(*[
            F.struct(F.lit(n).alias("feature"), vector_to_array("v")[i].alias("value"), vector_to_array("f")[i].alias("output"))
            for i, n in enumerate(names)
        ]))
    )
    return _count_by(indexed, "feature", "value", "output")


def standardize(spark, sf_dir):
    names = ["l_quantity", "l_discount", "l_tax", "fixed"]
    lines = fx.table(spark, sf_dir, "lineitem").withColumn("fixed", F.lit(49.617))
    for stage in features.scaled_stages(names):
        lines = stage.fit(lines).transform(lines) if isinstance(stage, StandardScaler) else stage.transform(lines)
    scaled = vector_to_array("features")
    return lines.select(*fx.ROW_KEYS, *[F.round(scaled[i], 6).alias(f"z_{n}") for i, n in enumerate(names)])


# --- metrics -----------------------------------------------------------------


def binary_confusion(spark, sf_dir):
    return metrics.binary_confusion(fx.judged(spark, sf_dir))


def binary_rates(spark, sf_dir):
    rates = metrics.binary_rates(fx.judged(spark, sf_dir))
    return fx.rounded(rates, 9, "precision", "recall", "accuracy", "class_accuracy")


def binary_report(spark, sf_dir):
    report = survey.binary_report(fx.judged(spark, sf_dir).withColumnRenamed("fine_score", "score"))
    return fx.rounded(report, 8, "value")


def binary_rates_zero(spark, sf_dir):
    """Nothing is predicted, so one denominator is zero."""
    rates = metrics.binary_rates(fx.judged(spark, sf_dir).withColumn("prediction", F.lit(0.0)))
    return fx.rounded(rates, 9, "precision", "recall", "accuracy", "class_accuracy")


def binary_auc(spark, sf_dir):
    return fx.rounded(metrics.binary_auc(fx.judged(spark, sf_dir), "fine_score"), 8, "roc_auc", "pr_auc")


def binary_auc_ties(spark, sf_dir):
    return fx.rounded(metrics.binary_auc(fx.judged(spark, sf_dir), "coarse_score"), 8, "roc_auc", "pr_auc")


def binary_auc_points(spark, sf_dir):
    """Areas of two scores at once."""
    scores = F.array(*(F.struct(F.lit(p).alias("point"), F.col(f"{p}_score").alias("score")) for p in ("coarse", "fine")))
    rows = fx.judged(spark, sf_dir).select("label", F.inline(scores))
    return fx.rounded(metrics.binary_auc_by(rows, ["point"]), 8, "roc_auc", "pr_auc")


def rule_search(spark, sf_dir):
    """Mean accuracy over five folds of the rules quantity > threshold, and their places."""
    rows = splits.assign_folds(fx.judged(spark, sf_dir), fx.ROW_KEYS)
    rules = F.posexplode(F.array(*map(F.lit, (10.0, 20.0, 30.0, 30.5, 40.0)))).alias("point", "threshold")
    right = F.col("label") == (F.col("coarse_score") > F.col("threshold")).cast("double")
    judged = rows.select("fold", "label", "coarse_score", rules).groupBy("point", "fold", "threshold")
    table = judged.agg(F.round(F.avg(right.cast("double")), 9).alias("metric"))
    return fx.rounded(tuning.ranked_points(table), 8, "mean_metric")


def multiclass_confusion(spark, sf_dir):
    return metrics.confusion_counts(fx.judged_classes(spark, sf_dir))


def multiclass_metrics(spark, sf_dir):
    found = metrics.multiclass_metrics(fx.judged_classes(spark, sf_dir))
    return fx.rounded(found, 9, *found.columns)


def regression_metrics(spark, sf_dir):
    lines = fx.table(spark, sf_dir, "lineitem").select(
        (F.col("l_extendedprice") / 1000).alias("label"), (F.col("l_quantity") * 2).alias("prediction")
    )
    return fx.rounded(metrics.regression_metrics(lines), 6, "mse", "rmse", "mae", "r2")


def feature_correlation(spark, sf_dir):
    inputs = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
    lines = fx.table(spark, sf_dir, "lineitem").select(*inputs, "l_extendedprice")
    return fx.rounded(metrics.feature_correlation(lines, inputs, "l_extendedprice"), 6, "correlation")


# --- ranking -----------------------------------------------------------------


def _labelled_popular(spark, sf_dir):
    data = model_queries.prepared(spark, sf_dir)
    lists = ranking.same_list(data.test.select("user").distinct(), data.popular)
    return ranking.label_lists(lists, data.test), data.test


def popular_lists(spark, sf_dir):
    users = fx.interactions(spark, sf_dir).select("user").distinct()
    return ranking.same_list(users, _top(spark, sf_dir))


def label_lists(spark, sf_dir):
    return _labelled_popular(spark, sf_dir)[0]


def _list_areas(spark, sf_dir):
    return ranking.list_auc(_labelled_popular(spark, sf_dir)[0])


def list_auc_stepwise(spark, sf_dir):
    return fx.rounded(_list_areas(spark, sf_dir).drop("exact"), 9, "stepwise")


def list_auc_exact(spark, sf_dir):
    return fx.rounded(_list_areas(spark, sf_dir).drop("stepwise"), 9, "exact")


def pooled_auc(spark, sf_dir):
    return fx.rounded(ranking.pooled_auc(_labelled_popular(spark, sf_dir)[0]), 9, "stepwise", "exact")


def rank_metrics_at_k(spark, sf_dir):
    labelled, test = _labelled_popular(spark, sf_dir)
    found = ranking.rank_metrics(ranking.list_auc(labelled), test)
    return fx.rounded(found, 9, "stepwise", "exact", "precision", "recall", "jaccard")


def popular_macro_metrics(spark, sf_dir):
    labelled, test = _labelled_popular(spark, sf_dir)
    found = ranking.macro_rank_metrics(labelled, test)
    return fx.rounded(found, 8, "stepwise", "exact", "precision", "recall", "jaccard")


def popular_macro_auc(spark, sf_dir):
    """Active users, per-user split, popular list, stepwise and exact AUC, macro means."""
    found = recommender.baseline(model_queries.prepared(spark, sf_dir))
    return fx.rounded(found, 8, "stepwise", "exact")


# --- models with a closed form -----------------------------------------------


def ols_one_feature(spark, sf_dir):
    lines = fx.table(spark, sf_dir, "lineitem").select(
        (F.col("l_extendedprice") / 1000).alias("label"), "l_quantity"
    )
    vectors = VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(lines)
    fitted = LinearRegression(maxIter=100).fit(vectors)
    numbers = (round(float(fitted.coefficients[0]), 4), round(float(fitted.intercept), 4))
    return spark.createDataFrame([numbers], "slope double, intercept double")


def _stump_inputs(spark, sf_dir):
    lines = fx.labelled(spark, sf_dir).select(
        F.when(F.col("answer") == "Yes", 1.0).otherwise(0.0).alias("label"),
        (F.col("l_extendedprice") / 1000).alias("price"),
        "l_quantity", "l_discount", "l_tax", "l_linenumber",
    )
    inputs = ["l_linenumber", "l_quantity", "l_discount", "l_tax"]
    return VectorAssembler(inputCols=inputs, outputCol="features").transform(lines)


def tree_stump(spark, sf_dir):
    """A tree of one split, found again by trying all splits in SQL."""
    rows = _stump_inputs(spark, sf_dir)
    model = DecisionTreeClassifier(impurity="gini", maxDepth=1, maxBins=64, seed=42).fit(rows)
    leaves = model.transform(rows).select("prediction", F.round(vector_to_array("probability")[1], 9).alias("share"))
    return _count_by(leaves, "prediction", "share")


def tree_depth_points(spark, sf_dir):
    """Depth 1 of a tree of depth 6: the leaves of tree_stump."""
    rows = _stump_inputs(spark, sf_dir)
    model = DecisionTreeClassifier(impurity="gini", maxDepth=6, maxBins=64, seed=42).fit(rows)
    cut = tree_depths.depth_tallies(model, rows, [1])
    return cut.groupBy("prediction", F.round(tree_depths.tree_score("probability"), 9).alias("share")).agg(F.sum("n").alias("n"))


def forest_stump(spark, sf_dir):
    """A regression forest of one whole-sample tree with one split."""
    rows = _stump_inputs(spark, sf_dir)
    model = RandomForestRegressor(
        labelCol="price", numTrees=1, maxDepth=1, maxBins=64, bootstrap=False, seed=42,
        featureSubsetStrategy="all",
    ).fit(rows)
    return _count_by(model.transform(rows).select(F.round("prediction", 6).alias("prediction")), "prediction")


def ols_holdout(spark, sf_dir):
    """Unpenalised regression on the early years, judged on the two later ones."""
    lines = fx.ordered_lines(spark, sf_dir).select(
        F.year("o_orderdate").alias("year"), (F.col("l_extendedprice") / 1000).alias("price"), "l_quantity", "l_discount"
    )
    rows = splits.temporal_split(lines, "year", (1995, 1999), 2000, 2001).drop("year")
    rows = write_intermediate(rows, "yearly-lines", partition_by="split")  # every stage of the fit reads them again
    stages = features.scaled_stages(["l_quantity", "l_discount"])
    model = Pipeline(stages=[*stages, LinearRegression(labelCol="price", maxIter=100)]).fit(rows.filter("split = 'train'"))
    scored = model.transform(rows.filter("split <> 'train'"))
    found = metrics.regression_metrics_by(scored, ["split"], "price")
    return fx.rounded(found, 6, "mse", "rmse", "mae", "r2")


QUERIES: dict[str, Query] = {
    "popular_macro_auc": popular_macro_auc,
    "parse_fixed_width": parse_fixed_width_records,
    "fixed_width_rejects": fixed_width_rejects,
    "parse_dimension_lenient": parse_dimension_lenient,
    "dimension_rejects": dimension_rejects,
    "parse_alias": parse_alias_lines,
    "parse_facts": parse_fact_lines,
    "fact_rejects": fact_rejects,
    "survey_csv": survey_csv,
    "load_shape": load_shape,
    "alias_resolve": alias_resolve,
    "alias_merge": alias_merge,
    "name_lookup_default": name_lookup_default,
    "active_users": active_users,
    "active_facts": active_facts,
    "user_item_sets": user_item_sets,
    "item_popularity": item_popularity,
    "top_n_popular": top_n_popular,
    "top_n_report": top_n_report,
    "exclude_rated": exclude_rated,
    "distinct_ids": distinct_ids,
    "max_user": max_user,
    "synthetic_user": synthetic_user,
    "union_new_user": union_new_user,
    "hash_split": hash_split,
    "temporal_holdout": temporal_holdout,
    "per_user_split": per_user_split,
    "kfold_assign": kfold_assign,
    "sample_ids": sample_ids,
    "cyclical_encoding": cyclical_encoding,
    "string_index_keep": string_index_keep,
    "category_levels": category_levels,
    "dense_ids": dense_ids,
    "string_index_label": string_index_label,
    "assemble_vector": assemble_vector,
    "category_detect": category_detect,
    "standardize": standardize,
    "binary_confusion": binary_confusion,
    "binary_rates": binary_rates,
    "binary_rates_zero": binary_rates_zero,
    "binary_report": binary_report,
    "binary_auc": binary_auc,
    "binary_auc_ties": binary_auc_ties,
    "binary_auc_points": binary_auc_points,
    "rule_search": rule_search,
    "multiclass_confusion": multiclass_confusion,
    "multiclass_metrics": multiclass_metrics,
    "regression_metrics": regression_metrics,
    "feature_correlation": feature_correlation,
    "popular_lists": popular_lists,
    "label_lists": label_lists,
    "list_auc_stepwise": list_auc_stepwise,
    "list_auc_exact": list_auc_exact,
    "pooled_auc": pooled_auc,
    "rank_metrics_at_k": rank_metrics_at_k,
    "popular_macro_metrics": popular_macro_metrics,
    "ols_one_feature": ols_one_feature,
    "ols_holdout": ols_holdout,
    "tree_stump": tree_stump,
    "tree_depth_points": tree_depth_points,
    "forest_stump": forest_stump,
    **model_queries.QUERIES,
}
