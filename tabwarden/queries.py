"""The registered queries: every operator run over whole test tables."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tabwarden.fixtures import FEATURES, parts, site_traits, table
from tabwarden.functions import recode_label
from tabwarden.models import families, search
from tabwarden.models.adaboost import AdaBoostClassifier
from tabwarden.operators import curves, drift, metrics, profile, scale, split, validate
from tabwarden.operators.impute import KNNImputer
from tabwarden.plans import runs, scoring, selection, training
from tabwarden.session import materialise, new_path
from tabwarden.sources import append_load, na_to_null, probe_columns, read_csv, rows_to_json, scan_clean, write_csv
from tabwarden.spec import PHISHING
from tabwarden.streaming.score import stream_score as start_stream_score

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
DRIFT_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
DRIFT_SINCE = "2000-01-01"
ORDERS_SINCE = "1999-01-01"
RUN_ID = "09_02_2025_00_27_02"


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    doubles = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(F.col(c), digits) for c in doubles}) if doubles else df


# --- sources, projections, profiles -------------------------------------------------


def scan_clean_query(spark: SparkSession, sf: str) -> DataFrame:
    return scan_clean(site_traits(spark, sf).withColumn("created_at", F.current_timestamp()), PHISHING)


def na_to_null_query(spark: SparkSession, sf: str) -> DataFrame:
    text = site_traits(spark, sf).withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("na")) for c in FEATURES})
    return na_to_null(text, numeric=PHISHING.names)


def label_recode(spark: SparkSession, sf: str) -> DataFrame:
    return site_traits(spark, sf).select("id", recode_label(F.col("Result")).alias("label"))


def preview(spark: SparkSession, sf: str) -> DataFrame:
    return profile.preview(site_traits(spark, sf), "id", ["id", *FEATURES[:4]])


def rows_to_json_query(spark: SparkSession, sf: str) -> DataFrame:
    return rows_to_json(site_traits(spark, sf)).select("id", "record")


def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "csv")
    write_csv(site_traits(spark, sf), path)
    return read_csv(spark, path)


def append_load_query(spark: SparkSession, sf: str) -> DataFrame:
    """Load the orders twice: the rows double, and every row has its own id."""
    name = f"orders_{uuid.uuid4().hex}"
    location = new_path(spark, "orders-load")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    written = append_load(orders, name, location) + append_load(orders, name, location)
    loaded = spark.read.table(name)
    per_status = loaded.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("id").alias("n_ids"),
        F.countDistinct("o_orderkey").alias("n_orders"),
        F.round(F.sum(F.col("o_totalprice").cast("decimal(18,2)")), 2).cast("double").alias("total_price"),
        F.count("created_at").alias("n_loaded_at"),
    )
    return per_status.withColumn("n_written", F.lit(written).cast("bigint"))


def source_probe(spark: SparkSession, sf: str) -> DataFrame:
    probed = _union([probe_columns(t, table(spark, sf, t)) for t in TABLES])
    return probed.select("table_name", "n_rows", "column_name", "position")


def class_balance(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(profile.class_balance(site_traits(spark, sf), "Result"))


def value_counts(spark: SparkSession, sf: str) -> DataFrame:
    counted = lambda df, c: profile.value_counts(df, c).select(F.lit(c).alias("column_name"), F.col(c).alias("value"), "n")
    return counted(site_traits(spark, sf), "Result").unionByName(counted(table(spark, sf, "labels"), "quality"))


def null_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile.null_profile(site_traits(spark, sf), PHISHING.names)


def range_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile.range_profile(table(spark, sf, "lineitem"), DRIFT_COLUMNS)


# --- checks ---------------------------------------------------------------------------


def _varied(good: DataFrame) -> dict[str, DataFrame]:
    every = F.col("id") % 1000 == 0
    return {
        "good": good,
        "column_missing": good.drop("Favicon"),
        "column_added": good.withColumn("extra", F.lit(1)),
        "text_column": good.withColumn("URL_Length", F.col("URL_Length").cast("string")),
        "label_zero": good.withColumn("Result", F.when(every, F.lit(0)).otherwise(F.col("Result"))),
        "label_null": good.withColumn("Result", F.when(~every, F.col("Result"))),
    }


def _variants(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return _varied(site_traits(spark, sf))


def check_columns(spark: SparkSession, sf: str) -> DataFrame:
    return _union([validate.check_columns(df.drop("id"), PHISHING, name) for name, df in _variants(spark, sf).items()])


def check_numeric(spark: SparkSession, sf: str) -> DataFrame:
    return _union([validate.check_numeric(df.drop("id"), PHISHING, name) for name, df in _variants(spark, sf).items()])


def check_target(spark: SparkSession, sf: str) -> DataFrame:
    return _union([validate.check_target(df, PHISHING, name) for name, df in _variants(spark, sf).items()])


def target_violations(spark: SparkSession, sf: str) -> DataFrame:
    frames = []
    for name, df in _variants(spark, sf).items():
        found = validate.target_violations(df, PHISHING)
        frames.append(found.select(F.lit(name).alias("dataset"), F.coalesce("value", F.lit("null")).alias("value"), "n"))
    return _union(frames)


def _dated(spark: SparkSession, sf: str) -> DataFrame:
    return site_traits(spark, sf, (F.col("o_orderdate") >= ORDERS_SINCE).alias("later"))


def validation_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Each variant as the later set, checked together with the good earlier set."""
    dated = _dated(spark, sf)
    good = dated.where(~F.col("later")).drop("id", "later")
    frames = []
    for name, df in _varied(dated).items():
        gate = validate.validation_gate(good, df.where("later").drop("id", "later"), PHISHING)
        frames.append(gate.select(F.lit(name).alias("variant"), "*"))
    return _union(frames)


def routing(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of both sets of every variant on the valid and on the invalid side, read back."""
    dated = _dated(spark, sf)
    good = dated.where(~F.col("later")).drop("id", "later")
    frames = []
    for name, df in _varied(dated).items():
        _, folder = validate.route(good, df.where("later").drop("id", "later"), PHISHING, new_path(spark, "routing"))
        for part in ("train", "test"):
            rows = spark.read.parquet(f"{folder}/{part}")
            frames.append(rows.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(name).alias("variant"), F.lit(folder.rpartition("status=")[2]).alias("status"), F.lit(part).alias("dataset"), "n_rows"
            ))
    return _union(frames)


# --- drift ------------------------------------------------------------------------------


def _lineitem_samples(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    items = table(spark, sf, "lineitem")
    return items.where(F.col("l_shipdate") < DRIFT_SINCE), items.where(F.col("l_shipdate") >= DRIFT_SINCE)


def ks_stat(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(drift.ks_stat(*_lineitem_samples(spark, sf), DRIFT_COLUMNS).select("column_name", "n1", "n2", "d"), 9)


def ks_pvalue_asymp(spark: SparkSession, sf: str) -> DataFrame:
    stats = drift.ks_stat(*_lineitem_samples(spark, sf), DRIFT_COLUMNS)
    return _rounded(drift.ks_test(stats, "asymptotic").select("column_name", "n1", "n2", "d", "p_value"))


def ks_pvalue_exact(spark: SparkSession, sf: str) -> DataFrame:
    """All orderings counted; the split by type is the comparison, every part is in one of the samples.

    One task counts a column. From about 169,600 parts on only places within the gap are visited, so the gap decides
    how large the samples may be.
    """
    part = table(spark, sf, "part")
    economy = F.col("p_type") == "ECONOMY"
    stats = drift.ks_stat(part.where(~economy), part.where(economy), ["p_size", "p_retailprice"])
    return _rounded(drift.ks_test(stats, "exact").select("column_name", "n1", "n2", "d", "p_value"))


def ks_segments(spark: SparkSession, sf: str) -> DataFrame:
    """Every supplier's own lines, earlier against later: as many samples as suppliers, each of a size that does not grow."""
    stats = drift.ks_by_segment(*_lineitem_samples(spark, sf), "l_suppkey", DRIFT_COLUMNS[:2])
    tested = drift.ks_test(drift.ks_test(stats).withColumnRenamed("p_value", "p_asymptotic"), "exact", refused="null")
    return _rounded(tested.select("l_suppkey", "column_name", "n1", "n2", "d", "p_asymptotic", "p_value"))


def drift_report(spark: SparkSession, sf: str) -> DataFrame:
    """The measures, one with gaps on one side, and a column without any value."""
    gaps = F.when(F.col("l_linenumber") > 1, F.col("l_quantity"))
    base, current = _lineitem_samples(spark, sf)
    extra = {"some_missing": gaps, "all_missing": F.lit(None).cast("double")}
    return _rounded(drift.drift_report(base.withColumns(extra | {"some_missing": F.col("l_quantity")}), current.withColumns(extra), [*DRIFT_COLUMNS, *extra]))


def drift_summary(spark: SparkSession, sf: str) -> DataFrame:
    return drift.drift_summary(drift.drift_report(*_lineitem_samples(spark, sf), DRIFT_COLUMNS))


# --- split, imputation, scaling -------------------------------------------------------------


def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return split.stratified_split(orders, "o_orderkey", "o_orderstatus")


def random_split(spark: SparkSession, sf: str) -> DataFrame:
    return split.random_split(table(spark, sf, "events").select("event_id", "event_type"), "event_id")


def stratified_folds(spark: SparkSession, sf: str) -> DataFrame:
    return split.stratified_folds(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "quality")


def knn_impute(spark: SparkSession, sf: str) -> DataFrame:
    df = parts(spark, sf)
    model = KNNImputer(inputCols=["x1", "x2", "x3"], keyCol="p_partkey").fit(df)
    return _rounded(model.transform(df))


def knn_impute_apply(spark: SparkSession, sf: str) -> DataFrame:
    """Donors from the training rows, values for the test rows."""
    df = split.random_split(parts(spark, sf), "p_partkey")
    train, test = [df.where(F.col("split") == s).drop("split") for s in ("train", "test")]
    model = KNNImputer(inputCols=["x1", "x2", "x3"], keyCol="p_partkey").fit(train)
    return _rounded(model.transform(test))


def assemble(spark: SparkSession, sf: str) -> DataFrame:
    """The matrix of the web-site table: 30 imputed features in order, then the label."""
    df = site_traits(spark, sf)
    imputer = scoring.fit_imputer(df, FEATURES, "id")
    matrix = scoring.assemble(imputer, df.withColumn("label", recode_label(F.col("Result"))), ["id", "label"])
    x = vector_to_array("features")
    return _rounded(matrix.select("id", "label", *[x[i].alias(f"x{i}") for i in range(len(FEATURES))]))


def standard_scale(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    return _rounded(scale.standard_scale(part, scale.scaler_stats(part, ["p_size", "p_retailprice"])))


# --- metrics ----------------------------------------------------------------------------------


def _label_counts(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.confusion(table(spark, sf, "labels"), "quality", "toxic")


def confusion(spark: SparkSession, sf: str) -> DataFrame:
    return _label_counts(spark, sf)


def confusion_cells(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.confusion_cells(table(spark, sf, "labels"), "quality", "toxic")


def binary_scores(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(metrics.binary_scores(_label_counts(spark, sf)).select("precision", "recall", "f1_score"))


def weighted_scores(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(metrics.weighted_scores(_label_counts(spark, sf)).select("accuracy", "precision", "recall", "f1_score"))


def class_report(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(metrics.class_report(_label_counts(spark, sf)))


def _scored_labels(spark: SparkSession, sf: str) -> DataFrame:
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    return labels.join(table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id")


def roc_auc(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(curves.roc_auc(_scored_labels(spark, sf), "quality", "n_chars"))


def average_precision(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(curves.average_precision(_scored_labels(spark, sf), "quality", "n_chars"))


def roc_curve(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(curves.roc_curve(_scored_labels(spark, sf), "quality", "n_chars"))


def pr_curve(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(curves.pr_curve(_scored_labels(spark, sf), "quality", "n_chars"))


def roc_curve_bounded(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(curves.roc_curve(_scored_labels(spark, sf), "quality", "n_chars", max_points=41))


def pr_curve_bounded(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(curves.pr_curve(_scored_labels(spark, sf), "quality", "n_chars", max_points=41))


def r2_score(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_custkey", "o_totalprice")
    means = orders.groupBy("o_custkey").agg(F.avg("o_totalprice").alias("guess"))
    return _rounded(metrics.r2_score(orders.join(means, "o_custkey"), "o_totalprice", "guess"))


# --- comparison, selection, run records -----------------------------------------------------------


def _rule_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Confusion counts of every one-rule model, all of them in one aggregation."""
    positive = F.col("Result") == 1
    models = []
    for i, c in enumerate(FEATURES):
        guess = F.coalesce(F.col(c) > 0, F.lit(False))
        cells = {"tn": ~positive & ~guess, "fp": ~positive & guess, "fn": positive & ~guess, "tp": positive & guess}
        models.append(F.struct(F.lit(c).alias("model"), F.lit(i).alias("position"), *[F.count_if(w).alias(n) for n, w in cells.items()]))
    whole = {"total_samples": F.count(F.lit(1)), "positive_samples": F.count_if(positive), "negative_samples": F.count_if(~positive)}
    counted = df.groupBy(*keys).agg(F.array(*models).alias("models"), *[e.alias(n) for n, e in whole.items()])
    return counted.select(*keys, *whole, F.inline("models"))


def _rule_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Binary scores of every one-rule model on the training and the test rows."""
    both = split.stratified_split(site_traits(spark, sf), "id", "Result")
    scores = metrics.binary_scores(_rule_counts(both, ["split"])).select("model", "split", "precision", "recall", "f1_score")
    return scores.withColumn("run_id", F.lit(RUN_ID))


def model_compare(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(selection.model_compare(metrics.weighted_scores(_rule_counts(site_traits(spark, sf), []))))


def select_best(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(selection.select_best(metrics.weighted_scores(_rule_counts(site_traits(spark, sf), []))))


def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(selection.run_summary(_rule_scores(spark, sf)))


def quality_gates(spark: SparkSession, sf: str) -> DataFrame:
    summary = selection.run_summary(_rule_scores(spark, sf))
    named = summary.withColumnsRenamed({"train_f1_score": "train_f1", "test_f1_score": "test_f1"})
    return _rounded(selection.quality_gates(named))


def run_tracking(spark: SparkSession, sf: str) -> DataFrame:
    """Every one-rule model recorded as a run of its own."""
    scored = metrics.binary_scores(_rule_counts(site_traits(spark, sf), [])).withColumns({"run_id": F.col("model"), "source": F.lit("orders")})
    rows = selection.tracking_rows(
        scored,
        ["f1_score", "precision", "recall"],
        extra=["total_samples", "source"],
        params=["model", "source"],
        tags={"task": "phishing_detection"},
    )
    number = F.expr("try_cast(value AS DOUBLE)")
    return rows.select(
        "run_id", "kind", "key", F.round(number, 6).alias("number"), F.when(number.isNull(), F.col("value")).alias("text")
    )


def run_retention(spark: SparkSession, sf: str) -> DataFrame:
    """A run for the start of every event, beside names of other folders; keep three."""
    events = table(spark, sf, "events")
    named = events.select(F.date_format("ts", runs.RUN_PATTERN).alias("name"))
    other = events.select(F.concat(F.lit("notes_"), F.col("event_type")).alias("name"))
    return runs.run_retention(named.unionByName(other), 3).select("name", "action")


# --- training, scoring ----------------------------------------------------------------------------------


def _matrix(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(train, test) of the web-site table with folds: a gap counts as 0, so that a fit stands on its own."""
    filled = site_traits(spark, sf).na.fill(0, FEATURES)
    table_ = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(filled)
    slim = table_.select("id", "features", "Result", recode_label(F.col("Result")).alias("label"))
    both = split.stratified_split(slim, "id", "Result")
    # Folds are cut in the training rows of a class; the test rows are a class of their own whose folds are dropped, so
    # that every vector is written once, together with both.
    both = both.withColumn("stratum", F.when(F.col("split") == "train", F.col("Result")))
    both = materialise(split.stratified_folds(both, "id", "stratum").drop("stratum"), "matrix")
    train, test = [both.where(F.col("split") == s).drop("split") for s in ("train", "test")]
    return train, test.drop("fold")


# Settings of the single fits, and the spaces of the side-by-side search.
FIT_PARAMS = {
    "Decision Tree": {"criterion": "gini", "max_depth": 7, "min_samples_leaf": 2},
    "Random Forest": {"n_estimators": 20, "max_depth": 7, "max_features": "sqrt"},
    "Gradient Boosting": {"learning_rate": 0.2, "subsample": 0.8, "n_estimators": 10, "max_depth": 4},
    "Logistic Regression": {"C": 0.1, "penalty": "l2"},
    "AdaBoost": {"learning_rate": 1.0, "n_estimators": 10},
}
SMALL_SPACE = {
    "Decision Tree": {"criterion": ["gini", "entropy"], "max_depth": [3, 5]},
    "Random Forest": {"n_estimators": [5, 10], "max_depth": [3, 5]},
    "Gradient Boosting": {"learning_rate": [0.1, 0.2], "n_estimators": [5], "max_depth": [3]},
    "Logistic Regression": {"C": [0.1, 1.0], "penalty": ["l2"]},
    "AdaBoost": {"learning_rate": [0.5, 1.0], "n_estimators": [5]},
}
# The published models of these families are better than one class for all by far more.
MARGIN = 0.05


def _facts(scored: DataFrame, keys: list[str]) -> DataFrame:
    """What must hold of a model's rows (label, prediction, p, the chance of class 1): all are predicted,
    the prediction follows from the chance, and it beats the majority clearly."""
    right = F.avg((F.col("label") == F.col("prediction")).cast("double"))
    share = F.avg(F.col("label").cast("double"))
    return scored.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("label") == 1).alias("n_positive"),
        F.count_if(F.col("prediction").isNull() | ~F.col("prediction").isin(0, 1)).alias("n_unpredicted"),
        F.count_if(F.coalesce((F.col("p") < 0) | (F.col("p") > 1) | ((F.col("p") > 0.5) != (F.col("prediction") == 1)), F.lit(True))).alias("n_off"),
        (right > F.greatest(share, 1 - share) + MARGIN).alias("beats_majority"),
    )


def _fit(family: str):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        train, test = _matrix(spark, sf)
        model = families.configured(family, FIT_PARAMS[family], train.count()).fit(train)
        both = train.select("label", "features").withColumn("split", F.lit("train")).unionByName(
            test.select("label", "features").withColumn("split", F.lit("test"))
        )
        scored = model.transform(both).withColumn("p", vector_to_array("probability")[1])
        return _facts(scored, ["split"]).withColumn("family", F.lit(family))

    return query


def adaboost_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Every row scored by three rounds of boosting on all rows."""
    train, test = _matrix(spark, sf)
    rows = train.drop("fold").unionByName(test)
    scored = AdaBoostClassifier(maxIter=3).fit(rows).transform(rows)
    return _rounded(scored.select("id", F.col("prediction").cast("int").alias("prediction"), vector_to_array("probability")[1].alias("p")))


def _search_facts(found: list[search.Found], test: DataFrame) -> DataFrame:
    """Per family: different models tried, and whether the best of them holds what was asked, scored as it
    should and beats the majority, on the folds and on the test rows."""
    rows = search.report(found, test)
    share = test.agg(F.avg(F.col("label").cast("double"))).first()[0]
    floor = max(share, 1 - share) + MARGIN
    ordered = F.row_number().over(Window.orderBy(F.desc("f1_score"), "model"))
    first = F.col("model") == selection.best_name(rows.withColumn("position", ordered))
    return rows.select(
        "model", "n_candidates", (F.col("accuracy") > floor).alias("beats_majority"), F.col("cv_score").between(0.5, 1.0).alias("folds_scored"),
        (first == (F.col("f1_score") == F.max("f1_score").over(Window.partitionBy()))).alias("best_is_first"),
    )


def r2_search(spark: SparkSession, sf: str) -> DataFrame:
    """R² of the predicted labels of every fold and candidate of a search over shallow trees, as the search records
    them, and which candidate it chose."""
    train, _ = _matrix(spark, sf)
    record = new_path(spark, "r2-search")
    found = search.grid_search(train, "Decision Tree", {"criterion": ["gini", "entropy"], "max_depth": [1, 2]}, average="r2", record=record)
    settings = F.from_json("params", "criterion string, max_depth int")
    scores = search.recorded(spark, record).select(settings.alias("s"), "fold", F.col("score").alias("r2"))
    chosen = (F.col("s.criterion") == found.params["criterion"]) & (F.col("s.max_depth") == found.params["max_depth"])
    return _rounded(scores.select("s.criterion", "s.max_depth", "fold", "r2", chosen.alias("chosen")))


def grid_search(spark: SparkSession, sf: str) -> DataFrame:
    """The whole declared grid of the tree."""
    train, test = _matrix(spark, sf)
    return _search_facts([search.grid_search(train, "Decision Tree")], test)


def random_search(spark: SparkSession, sf: str) -> DataFrame:
    """The declared space of logistic regression; its different models are fewer than the trials allowed."""
    train, test = _matrix(spark, sf)
    return _search_facts([search.random_search(train, "Logistic Regression")], test)


def family_search(spark: SparkSession, sf: str) -> DataFrame:
    train, test = _matrix(spark, sf)
    return _search_facts(search.search_families(train, SMALL_SPACE), test)


def _fitted_chain(spark: SparkSession, sf: str, family: str = "Decision Tree") -> PipelineModel:
    """Imputer, assembler and classifier, fitted on the training rows."""
    folder = new_path(spark, "transform")
    train, test = training.ingest(site_traits(spark, sf), PHISHING, "id", folder)
    imputer, train, _ = training.transform(train, test, PHISHING, folder)
    classifier = families.configured(family, FIT_PARAMS[family], train.count()).fit(train)
    return scoring.scoring_model(imputer, classifier)


def batch_score(spark: SparkSession, sf: str) -> DataFrame:
    """What holds of all rows scored without their label, which is joined only afterwards."""
    rows = site_traits(spark, sf)
    scored = scoring.batch_score(_fitted_chain(spark, sf), rows.drop("Result"))
    named = scored.select("id", F.col(scoring.PREDICTION).alias("prediction"), F.col(scoring.PROBABILITY).alias("p"))
    labels = rows.select("id", recode_label(F.col("Result")).alias("label"))
    return _facts(labels.join(named, "id", "left"), [])


def model_info(spark: SparkSession, sf: str) -> DataFrame:
    """Per feature: whether it is one the label was made from, and whether the tree leans on it."""
    train, _ = _matrix(spark, sf)
    classifier = families.configured("Decision Tree", FIT_PARAMS["Decision Tree"], train.count()).fit(train)
    imputer = KNNImputer(inputCols=FEATURES, outputCols=[f"{c}__imputed" for c in FEATURES], keyCol="id").fit(site_traits(spark, sf))
    info = scoring.model_info(scoring.scoring_model(imputer, classifier))
    total = F.sum("importance").over(Window.partitionBy())
    return info.select(
        "feature", "n_features", "has_probability", (F.abs(total - 1) < 1e-9).alias("shares_sum_to_one"),
        (F.col("importance") > 0.1).alias("leans_on_it"),
    )


def _compare(left: DataFrame, right: DataFrame) -> DataFrame:
    pair = left.select("id", "predicted_column").join(right.select("id", F.col("predicted_column").alias("other")), "id", "full")
    same = F.col("predicted_column") == F.col("other")
    return pair.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(~F.coalesce(same, F.lit(False))).alias("n_different"))


def model_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Rows scored differently after saving the chain and loading it again."""
    model = _fitted_chain(spark, sf)
    path = new_path(spark, "model")
    model.write().overwrite().save(path)
    rows = site_traits(spark, sf).drop("Result")
    return _compare(scoring.batch_score(model, rows), scoring.batch_score(training.load_model(path), rows))


def stream_score(spark: SparkSession, sf: str) -> DataFrame:
    """Rows scored differently as a stream of files and as one batch."""
    model = _fitted_chain(spark, sf)
    source, target, checkpoint = [new_path(spark, f"stream-{n}") for n in ("in", "out", "log")]
    rows = site_traits(spark, sf).drop("Result")
    rows.repartition(4).write.parquet(source)
    query = start_stream_score(spark, model, source, rows.schema, target, checkpoint, files_per_batch=2)
    query.awaitTermination()
    return _compare(scoring.batch_score(model, rows), spark.read.parquet(target))


def training_run(spark: SparkSession, sf: str) -> DataFrame:
    """The whole chain from the raw table to the recorded run: what must hold of its tables."""
    root = new_path(spark, "runs")
    run = training.training_run(site_traits(spark, sf), PHISHING, "id", root, run_id=RUN_ID, spaces=SMALL_SPACE)
    read = lambda name: spark.read.parquet(f"{run.folder}/{name}").where(F.col("run_id") == run.run_id)
    count = lambda name: read(name).count()
    summary = run.summary.first()
    rows = [
        ("models compared", count("comparison")),
        ("columns tested for drift", count("drift_report")),
        ("columns drifted", read("drift_report").where("drift_status").count()),
        ("training rows", spark.read.parquet(f"{run.folder}/transformed/train").count()),
        ("test rows", spark.read.parquet(f"{run.folder}/transformed/test").count()),
        ("gates", count("gates")),
        ("gates passed", read("gates").where("ok").count()),
        ("best model is a compared one", read("comparison").where(F.col("model") == run.best_model).count()),
        ("tracked metrics", spark.read.parquet(f"{root}/tracking").where((F.col("run_id") == RUN_ID) & (F.col("kind") == "metric")).count()),
        ("test score above the gate", int(summary["test_f1_score"] > 0.6)),
    ]
    loaded = scoring.batch_score(training.load_model(run.model_path), site_traits(spark, sf).drop("Result"))
    rows.append(("rows the stored model scores", loaded.where(F.col(scoring.PREDICTION).isin(0, 1)).count()))
    return spark.createDataFrame(rows, "fact string, n bigint")


QUERIES = {
    "scan_clean": scan_clean_query,
    "na_to_null": na_to_null_query,
    "label_recode": label_recode,
    "preview": preview,
    "rows_to_json": rows_to_json_query,
    "csv_roundtrip": csv_roundtrip,
    "append_load": append_load_query,
    "source_probe": source_probe,
    "class_balance": class_balance,
    "value_counts": value_counts,
    "null_profile": null_profile,
    "range_profile": range_profile,
    "check_columns": check_columns,
    "check_numeric": check_numeric,
    "check_target": check_target,
    "target_violations": target_violations,
    "validation_gate": validation_gate,
    "routing": routing,
    "ks_stat": ks_stat,
    "ks_pvalue_asymp": ks_pvalue_asymp,
    "ks_pvalue_exact": ks_pvalue_exact,
    "ks_segments": ks_segments,
    "drift_report": drift_report,
    "drift_summary": drift_summary,
    "stratified_split": stratified_split,
    "random_split": random_split,
    "stratified_folds": stratified_folds,
    "knn_impute": knn_impute,
    "knn_impute_apply": knn_impute_apply,
    "assemble": assemble,
    "standard_scale": standard_scale,
    "confusion": confusion,
    "confusion_cells": confusion_cells,
    "binary_scores": binary_scores,
    "weighted_scores": weighted_scores,
    "class_report": class_report,
    "roc_auc": roc_auc,
    "average_precision": average_precision,
    "roc_curve": roc_curve,
    "pr_curve": pr_curve,
    "roc_curve_bounded": roc_curve_bounded,
    "pr_curve_bounded": pr_curve_bounded,
    "r2_score": r2_score,
    "model_compare": model_compare,
    "select_best": select_best,
    "run_summary": run_summary,
    "quality_gates": quality_gates,
    "run_tracking": run_tracking,
    "run_retention": run_retention,
    "fit_tree": _fit("Decision Tree"),
    "fit_forest": _fit("Random Forest"),
    "fit_gbt": _fit("Gradient Boosting"),
    "fit_logistic": _fit("Logistic Regression"),
    "fit_adaboost": _fit("AdaBoost"),
    "adaboost_scores": adaboost_scores,
    "r2_search": r2_search,
    "grid_search": grid_search,
    "random_search": random_search,
    "family_search": family_search,
    "batch_score": batch_score,
    "model_info": model_info,
    "model_roundtrip": model_roundtrip,
    "stream_score": stream_score,
    "training_run": training_run,
}
