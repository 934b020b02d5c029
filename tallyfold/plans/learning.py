"""Regression and classification queries."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.operators import learning as L
from tallyfold.operators import splits as P
from tallyfold.plans.fixtures import Tables
from tallyfold.plans.registry import query
from tallyfold.session import materialize

CATEGORIES = ["l_linestatus", "o_orderpriority", "c_mktsegment"]
NUMBERS = [
    "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "o_totalprice",
    "c_acctbal", "month",
]
FEATURES = [*NUMBERS, *[f"{c}_index" for c in CATEGORIES]]


def _shipments(t: Tables):
    """Order lines with their order and customer, labelled by whether they came back."""
    lines = t["lineitem"].join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey"))
    lines = lines.join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
    return lines.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("key"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"),
        F.month("l_shipdate").alias("month"), *CATEGORIES,
        *[c for c in NUMBERS if c != "month"],
    )


def _classification(t: Tables):
    """Training and test rows with the eleven features, written once: fits read them many times."""
    shipments = materialize(_shipments(t), "shipments")
    indexed = L.index_categories(shipments, CATEGORIES)
    ready = L.assemble_features(indexed, FEATURES).select("key", "label", "features")
    return P.hash_split(materialize(ready, "features"), "key", 0.9, 42)


def _tasks(t: Tables) -> int:
    """Training partitions: one wave of tasks per iteration."""
    return t.spark.sparkContext.defaultParallelism


def _prices(t: Tables):
    rows = t["part"].select("p_partkey", "p_size", "p_retailprice")
    return P.hash_split(rows, "p_partkey", 0.9, 42)


_INDEX = " union all ".join(
    f"select '{c}' as column, {c} as value, cast(row_number() over (order by count(*) desc, {c}) - 1 "
    f"as double) as idx from s group by {c}"
    for c in CATEGORIES
)
_FEATURES_SQL = ", ".join(
    [f"cast({c} as double) as {c}" for c in NUMBERS]
    + [f"(select idx from i where i.column = '{c}' and i.value = s.{c}) as {c}_index" for c in CATEGORIES]
)


@query("assemble_features", f"""
with s as (select concat_ws('-', l_orderkey, l_linenumber, l_partkey) as key,
 cast(l_returnflag = 'R' as int) as label, month(l_shipdate) as month, * from lineitem
 join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey),
i as ({_INDEX}) select key, label, {_FEATURES_SQL} from s""")
def assemble_features(t: Tables):
    """Features as one vector, shown again as columns."""
    ready = L.assemble_features(L.index_categories(_shipments(t), CATEGORIES), FEATURES)
    parts = vector_to_array("features")
    return ready.select("key", "label", *[parts[i].alias(name) for i, name in enumerate(FEATURES)])


@query("index_categories", f"""
with s as (select l_linestatus, o_orderpriority, c_mktsegment from lineitem
 join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey) {_INDEX}""")
def index_categories(t: Tables):
    return L.index_table(_shipments(t), CATEGORIES)


def _share(key: str) -> str:
    return f"cast(('0x' || substring(md5('42-' || {key}), 1, 8)) as bigint) / 4294967296.0::double"


@query("regress_tree", f"""
select p_partkey, p_size, p_retailprice, true as is_leaf_mean from part
where {_share("cast(p_partkey as varchar)")} >= 0.9::double""")
def regress_tree(t: Tables):
    """The test rows, and whether each is predicted by the mean of its leaf."""
    train, test = _prices(t)
    found = L.leaf_means(train, test, ["p_partkey", "p_size"], "p_retailprice")
    return found.select("p_partkey", "p_size", "p_retailprice", "is_leaf_mean")


@query("eval_rmse", """
select sqrt(avg((l_extendedprice - l_quantity * 2000) * (l_extendedprice - l_quantity * 2000))) as rmse
from (select round(l_extendedprice) as l_extendedprice, l_quantity from lineitem)""")
def eval_rmse(t: Tables):
    guessed = t["lineitem"].select(
        F.round("l_extendedprice").alias("label"), (F.col("l_quantity") * 2000).alias("prediction")
    )
    return L.eval_rmse(guessed, "label")


@query("eval_accuracy", """
select cast(count_if(case when l_discount > 0.05 then 'R' else 'N' end = l_returnflag) as double) / count(*)
 as accuracy from lineitem""")
def eval_accuracy(t: Tables):
    guess = F.when(F.col("l_discount") > 0.05, "R").otherwise("N")
    return L.eval_accuracy(t["lineitem"].withColumn("prediction", guess), "l_returnflag")


# What SQL can state of a classifier: which rows it judges, that each gets one of the classes, and
# that it does no worse on them than always naming the commoner one.
_JUDGED = f"""
with s as (select concat_ws('-', l_orderkey, l_linenumber, l_partkey) as key,
 cast(l_returnflag = 'R' as int) as label from lineitem
 join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey)
select key, label, true as is_class, true as is_useful from s where {_share("key")} >= 0.9::double"""


def _judged(predicted: DataFrame) -> DataFrame:
    predicted = materialize(predicted.select("key", "label", "prediction"), "predictions")
    facts = predicted.agg(
        F.avg((F.col("label") == F.col("prediction")).cast("int")).alias("right"),
        F.avg("label").alias("share")).first()
    useful = facts["right"] is not None and facts["right"] >= 0.9 * max(facts["share"], 1 - facts["share"])
    return predicted.select(
        "key", "label", F.col("prediction").isin(0.0, 1.0).alias("is_class"), F.lit(useful).alias("is_useful"))


@query("classify_logistic", _JUDGED)
def classify_logistic(t: Tables):
    train, test = _classification(t)
    return _judged(L.classify_logistic(train, test, partitions=_tasks(t)))


@query("classify_mlp", _JUDGED)
def classify_mlp(t: Tables):
    train, test = _classification(t)
    return _judged(L.classify_mlp(train, test, partitions=_tasks(t)))


@query("fallback_model", "select 'logistic' as model, true as is_share, true as follows_rule")
def fallback_model(t: Tables):
    """The first model's row, and whether the choice follows from the accuracies reported."""
    train, test = _classification(t)
    report = L.fallback_model(train, test, floor=0.55, partitions=_tasks(t)).collect()
    rule = (len(report) == 1) == (report[0]["accuracy"] >= 0.55) and report[-1]["chosen"]
    rows = [(report[0]["model"], all(0 <= r["accuracy"] <= 1 for r in report), rule)]
    return t.spark.createDataFrame(rows, "model string, is_share boolean, follows_rule boolean")
