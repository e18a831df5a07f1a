"""Trees of several levels and ensembles of several rounds, next to SQL that grows the same ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.quality import stored_clean
from catalogue.sql import DOW, HOUR, MONTH, split_of, using
from tripkit.operators import splitting
from tripkit.plans import training
from tripkit.plans.features import build_features
from tripkit.session import materialize

CALENDAR = {"hour_of_day": HOUR, "day_of_week": DOW, "month": MONTH}
COMMON = {"featuresCol": "features", "labelCol": "label", "maxBins": training.BINS, "seed": 42}
#: Spark's defaults: the share of a later tree's prediction that is added.
LEVELS, STEP = 2, 0.1


def calendar_rows(spark, sf):
    table = splitting.hash_split(build_features(stored_clean(spark, sf)), "trip_id")
    slim = materialize(table.select("trip_id", *CALENDAR, "eta_minutes", "split"))
    return training.assemble(slim, list(CALENDAR), key="trip_id", keep=["split"])


def grown_tree(data):
    from pyspark.ml.regression import DecisionTreeRegressor

    return DecisionTreeRegressor(maxDepth=LEVELS, **COMMON).fit(data.where(F.col("split") == "train"))


def train_levels(spark, sf):
    """Metrics of a tree of two levels and of two boosted trees of two levels, on the calendar of all clean trips."""
    from pyspark.ml.regression import GBTRegressor

    data = calendar_rows(spark, sf)
    boosted = GBTRegressor(maxIter=2, maxDepth=LEVELS, stepSize=STEP, **COMMON).fit(data.where(F.col("split") == "train"))
    models = {"decision_tree": grown_tree(data), "gradient_boosting": boosted}
    tables = [training.split_metrics(name, model, data, ["train", "val", "test"]) for name, model in models.items()]
    return tables[0].unionByName(tables[1])


def tree_importance(spark, sf):
    """Importance of every feature of the tree of two levels, by value."""
    found = training.feature_importance(grown_tree(calendar_rows(spark, sf)), list(CALENDAR), spark)
    return found.withColumn("importance", F.round("importance", 6))


def grown(tag: str, source: str, label: str) -> str:
    """CTEs of a tree on ``label``: per level the best cut of each node, then {tag}p, the rows with their leaf's mean as pred."""
    names = ", ".join(f"'{c}'" for c in CALENDAR)
    value = "CASE feature " + " ".join(f"WHEN '{c}' THEN {c}" for c in CALENDAR) + " END"
    parts = [f"{tag}0 AS (SELECT *, 1 AS node FROM {source})"]
    for d in range(LEVELS):
        parts.append(f"""
{tag}c{d} AS (SELECT *, sum(n) OVER upto AS ln, sum(s) OVER upto AS ls, sum(n) OVER whole AS tn, sum(s) OVER whole AS ts
  FROM (SELECT node, feature, v, count(*) AS n, sum({label}) AS s
        FROM (SELECT node, {label}, unnest([{names}]) AS feature, unnest([{', '.join(CALENDAR)}]) AS v FROM {tag}{d} WHERE split = 'train')
        GROUP BY node, feature, v)
  WINDOW upto AS (PARTITION BY node, feature ORDER BY v), whole AS (PARTITION BY node, feature)),
{tag}b{d} AS (SELECT node, arg_max(feature, gain) AS feature, arg_max(v, gain) AS cut, max(gain) AS gain
  FROM (SELECT *, ls * ls / ln + (ts - ls) * (ts - ls) / (tn - ln) - ts * ts / tn AS gain FROM {tag}c{d} WHERE ln < tn) GROUP BY node),
{tag}{d + 1} AS (SELECT r.* EXCLUDE (node), 2 * r.node + coalesce(CAST({value} > cut AS INTEGER), 0) AS node
  FROM {tag}{d} r LEFT JOIN {tag}b{d} b ON r.node = b.node)""")
    parts.append(f"""
{tag}p AS (SELECT r.* EXCLUDE (node), pred FROM {tag}{LEVELS} r JOIN (SELECT node, avg({label}) FILTER (split = 'train') AS pred
  FROM {tag}{LEVELS} GROUP BY node) l ON r.node = l.node)""")
    return ",".join(parts)


def scored(name: str, source: str, error: str) -> str:
    return f"""
SELECT '{name}' AS model, split, count(*) AS n_rows, round(avg(abs({error})), 4) AS mae, round(sqrt(avg({error} * {error})), 4) AS rmse,
       round(1 - sum({error} * {error}) / (var_pop(y) * count(*)), 4) AS r2 FROM {source} GROUP BY split"""


ROWS = f"f AS (SELECT {split_of('trip_id')} AS split, eta_minutes AS y, " + ", ".join(f"{e} AS {c}" for c, e in CALENDAR.items()) + " FROM clean)"
# The second tree learns twice what the first one leaves, the negative gradient of the squared error.
LEVELS_SQL = using("flagged", f"""
WITH {ROWS}, {grown('t', 'f', 'y')},
left_over AS (SELECT * EXCLUDE (pred), pred AS first, 2 * (y - pred) AS rest FROM tp), {grown('u', 'left_over', 'rest')},
boosted AS (SELECT split, y, y - first - cast({STEP} as double) * pred AS e FROM up), single AS (SELECT split, y, y - pred AS e FROM tp)
{scored('decision_tree', 'single', 'e')} UNION ALL {scored('gradient_boosting', 'boosted', 'e')}""")

GAINS = " UNION ALL ".join(f"SELECT feature, gain FROM tb{d}" for d in range(LEVELS))
IMPORTANCE_SQL = using("flagged", f"""
WITH {ROWS}, {grown('t', 'f', 'y')}, g AS ({GAINS})
SELECT feature, round(coalesce((SELECT sum(gain) FROM g WHERE g.feature = n.feature), 0) / (SELECT sum(gain) FROM g), 6) AS importance
FROM (SELECT unnest([{', '.join(f"'{c}'" for c in CALENDAR)}]) AS feature) n""")


QUERIES = {
    "train_levels": (train_levels, LEVELS_SQL),
    "tree_importance": (tree_importance, IMPORTANCE_SQL),
}
