"""Recommendation queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallygrain.operators import recommend as rec, relational as rel
from tallygrain.plans.registry import query
from tallygrain.plans.standins import RATED_ITEMS_MIN, RATED_USERS_MIN
from tallygrain.session import materialize

NS = [1, 3, 5, 10, 15, 20]
NEIGHBOURS, ITEMS_KEPT, OVERLAP = 50, 30, 2

ACTIVE = """
    r AS (SELECT "user", item, rating FROM ratings WHERE item IN (SELECT item FROM ratings GROUP BY item HAVING count(*) >= 70)
          AND "user" IN (SELECT "user" FROM ratings GROUP BY "user" HAVING count(*) >= 45))"""
BUCKET = "('0x' || substr(md5({key}::VARCHAR), 1, 8))::BIGINT % {n}"
SPLIT = ACTIVE + f""",
    w AS (SELECT "user", arg_max(item, md5("user"::VARCHAR || ':' || item::VARCHAR)) AS out FROM r GROUP BY 1),
    roles AS (SELECT "user", item, rating, CASE WHEN {BUCKET.format(key='"user"', n=100)} < 75 THEN 'train' WHEN item = out THEN 'withheld' ELSE 'given' END AS role
              FROM r JOIN w USING ("user"))"""


def z_of(name: str, source: str) -> str:
    return f"""
    {name} AS (SELECT "user", item, rating, mean, sd, coalesce((rating - mean) / nullif(sd, 0), 0) AS z FROM ({source})
           JOIN (SELECT "user", avg(rating) AS mean, coalesce(stddev_samp(rating), 0) AS sd FROM ({source}) GROUP BY 1) USING ("user"))"""


COS = "round(sum(g.z * t.z) / nullif(sqrt(sum(g.z * g.z)) * sqrt(sum(t.z * t.z)), 0), 9)"
BACK = """SELECT "user", item, round(any_value(mean) + any_value(sd) * (sum(sim * z) / nullif(sum(abs(sim)), 0)), 6) AS predicted"""


def ubcf_sql(given: str, train: str, apart: str = 'g."user" <> t."user"') -> str:
    return f"""
    us AS (SELECT g."user" AS a, t."user" AS b, {COS} AS sim FROM {given} g JOIN {train} t ON g.item = t.item AND {apart} GROUP BY 1, 2 HAVING count(*) >= 2),
    un AS (SELECT * FROM us WHERE sim IS NOT NULL QUALIFY row_number() OVER (PARTITION BY a ORDER BY sim DESC, b) <= 50),
    up AS ({BACK} FROM (SELECT a AS "user", t.item, sim, t.z FROM un JOIN {train} t ON un.b = t."user") p
           JOIN (SELECT "user", any_value(mean) AS mean, any_value(sd) AS sd FROM {given} GROUP BY 1) USING ("user")
           WHERE NOT EXISTS (SELECT 1 FROM {given} s WHERE s."user" = p."user" AND s.item = p.item) GROUP BY 1, 2)"""


def ibcf_sql(given: str, train: str) -> str:
    return f"""
    js AS (SELECT g.item AS a, t.item AS b, {COS} AS sim FROM {train} g JOIN {train} t ON g."user" = t."user" AND g.item <> t.item GROUP BY 1, 2 HAVING count(*) >= 2),
    jn AS (SELECT * FROM js WHERE sim IS NOT NULL QUALIFY row_number() OVER (PARTITION BY a ORDER BY sim DESC, b) <= 30),
    ip AS ({BACK} FROM (SELECT g."user", jn.a AS item, sim, g.z, mean, sd FROM {given} g JOIN jn ON g.item = jn.b) p
           WHERE NOT EXISTS (SELECT 1 FROM {given} s WHERE s."user" = p."user" AND s.item = p.item) GROUP BY 1, 2)"""


def ranked_sql(source: str) -> str:
    return f"""SELECT "user", item, predicted, row_number() OVER (PARTITION BY "user" ORDER BY predicted DESC, item) AS rank FROM {source} WHERE predicted IS NOT NULL"""


MODELS = SPLIT + "," + z_of("gz", "SELECT * FROM roles WHERE role = 'given'") + "," + z_of("tz", "SELECT * FROM roles WHERE role = 'train'")


def eval_sql(algorithm: str, source: str) -> str:
    return f"""SELECT '{algorithm}' AS algorithm, n::INT AS n, sum(tp)::BIGINT AS tp, sum(fp)::BIGINT AS fp, sum(fn)::BIGINT AS fn, sum(items - given - tp - fp - fn)::BIGINT AS tn FROM (
      SELECT n, given, (SELECT count(DISTINCT item) FROM r) AS items, CASE WHEN rank <= n AND rating >= 4 THEN 1 ELSE 0 END AS tp,
             least(coalesce(listed, 0), n) - CASE WHEN rank <= n AND rating >= 4 THEN 1 ELSE 0 END AS fp,
             (rating >= 4)::INT - CASE WHEN rank <= n AND rating >= 4 THEN 1 ELSE 0 END AS fn
      FROM (SELECT w."user", w.rating, k.rank, l.listed, s.given, unnest([1, 3, 5, 10, 15, 20]) AS n
            FROM (SELECT * FROM roles WHERE role = 'withheld') w
            JOIN (SELECT "user", count(*) AS given FROM roles WHERE role = 'given' GROUP BY 1) s USING ("user")
            LEFT JOIN (SELECT "user", count(*) AS listed FROM ({ranked_sql(source)}) WHERE rank <= 20 GROUP BY 1) l USING ("user")
            LEFT JOIN ({ranked_sql(source)}) k ON k."user" = w."user" AND k.item = w.item AND k.rank <= 20)) GROUP BY n"""


RATES = """algorithm, n, tp, fp, fn, tn, round(tp / nullif(tp + fp, 0), 6) AS precision, round(tp / nullif(tp + fn, 0), 6) AS recall,
      round(tp / nullif(tp + fn, 0), 6) AS tpr, round(fp / nullif(fp + tn, 0), 6) AS fpr"""
EVAL = MODELS + "," + ubcf_sql("gz", "tz") + "," + ibcf_sql("gz", "tz") + f""",
    e AS ({eval_sql('ubcf', 'up')} UNION ALL {eval_sql('ibcf', 'ip')}),
    rates AS (SELECT {RATES} FROM e)"""


def active(t):
    ratings = materialize(t.ratings, "ratings")  # both counts and the filter read it
    return rec.min_activity(ratings, RATED_USERS_MIN, RATED_ITEMS_MIN).select("user", "item", "rating")


@query("rec_activity_counts", """
    SELECT 'user' AS axis, "user" AS key, count(*) AS n, count(*) = max(count(*)) OVER () AS most_active FROM ratings GROUP BY "user"
    UNION ALL SELECT 'item', item, count(*), count(*) = max(count(*)) OVER () FROM ratings GROUP BY item""", ("ratings",))
def _(t):
    parts = []
    for axis in ["user", "item"]:
        counts = rel.group_counts(t.ratings, axis)
        most = counts.agg(F.max("n")).scalar()
        parts.append(counts.select(F.lit(axis).alias("axis"), F.col(axis).cast("bigint").alias("key"), "n", (F.col("n") == most).alias("most_active")))
    return parts[0].unionByName(parts[1])


@query("rec_min_activity_filter", """
    SELECT "user", item, rating, user_ratings, item_ratings FROM (SELECT *, count(*) OVER (PARTITION BY "user") AS user_ratings,
    count(*) OVER (PARTITION BY item) AS item_ratings FROM ratings) WHERE user_ratings >= 45 AND item_ratings >= 70""", ("ratings",))
def _(t):
    return rec.min_activity(t.ratings, RATED_USERS_MIN, RATED_ITEMS_MIN)


@query("rec_to_ratings", 'SELECT "user", item, rating FROM ratings', ("ratings",))
def _(t):
    return t.ratings


@query("rec_row_stats", """
    SELECT 'user' AS axis, "user" AS key, count(*) AS n, round(avg(rating), 6) AS mean_rating FROM ratings GROUP BY "user"
    UNION ALL SELECT 'item', item, count(*), round(avg(rating), 6) FROM ratings GROUP BY item""", ("ratings",))
def _(t):
    parts = [t.ratings.groupBy(F.col(axis).cast("bigint").alias("key")).agg(F.count("*").alias("n"), F.round(F.avg("rating"), 6).alias("mean_rating"))
             .select(F.lit(axis).alias("axis"), "key", "n", "mean_rating") for axis in ["user", "item"]]
    return parts[0].unionByName(parts[1])


@query("rec_zscore", "+" + z_of("z", 'SELECT "user", item, rating FROM ratings') + """
---
    SELECT "user", item, round(z, 6) + 0.0 AS z FROM z""", ("ratings",))
def _(t):
    return rec.zscore(t.ratings).select("user", "item", (F.round("z", 6) + F.lit(0.0)).alias("z"))


@query("rec_rating_distribution", "SELECT rating, count(*) AS n FROM ratings GROUP BY rating", ("ratings",))
def _(t):
    return rel.group_counts(t.ratings, "rating")


def _first(t, axis: str):
    """Active ratings of the first ten users or items, whose similarities are compared."""
    rated = active(t)
    return rated.join(rated.select(axis).distinct().orderBy(axis).limit(10), axis, "left_semi")


def _pairs_sql(row: str, column: str) -> str:
    return f"""+{ACTIVE},
    f AS (SELECT * FROM r WHERE {row} IN (SELECT DISTINCT {row} FROM r ORDER BY 1 LIMIT 10))
---
    SELECT x.{row}::BIGINT AS a, y.{row}::BIGINT AS b, count(*) AS n, round(sum(x.rating * y.rating) / (sqrt(sum(x.rating * x.rating)) * sqrt(sum(y.rating * y.rating))), 9) AS sim
    FROM f x JOIN f y ON x.{column} = y.{column} AND x.{row} < y.{row} GROUP BY 1, 2 HAVING count(*) >= 2"""


@query("rec_user_similarity", _pairs_sql('"user"', "item"), ("ratings",))
def _(t):
    return rec.similarity(_first(t, "user"), "user")


@query("rec_item_similarity", _pairs_sql("item", '"user"'), ("ratings",))
def _(t):
    return rec.similarity(_first(t, "item"), "item")


@query("rec_split", "+" + SPLIT + """
---
    SELECT * FROM roles""", ("ratings",))
def _(t):
    marked = rec.withhold_one(active(t))
    train = rec.split_fold(75)(F.col("user")) == 1
    return marked.select("user", "item", "rating", F.when(train, "train").when(F.col("withheld"), "withheld").otherwise("given").alias("role"))


@query("rec_kfold", f"""SELECT "user", ({BUCKET.format(key='"user"', n=5)})::INT AS fold, count(*) AS n FROM ratings GROUP BY 1""", ("ratings",))
def _(t):
    return t.ratings.groupBy("user").agg(F.count("*").alias("n")).select("user", rec.k_fold(5)(F.col("user")).alias("fold"), "n")


def _given_train(t):
    marked = materialize(rec.withhold_one(materialize(active(t), "active")), "ratings-withheld")
    train = rec.split_fold(75)(F.col("user")) == 1
    columns = ["user", "item", "rating"]
    return marked.where(~train & ~F.col("withheld")).select(*columns), marked.where(train).select(*columns)


@query("rec_ubcf", "+" + MODELS + "," + ubcf_sql("gz", "tz") + """
---
    SELECT "user", item, predicted FROM up WHERE predicted IS NOT NULL""", ("ratings",))
def _(t):
    given, train = _given_train(t)
    return rec.ubcf(given, train, NEIGHBOURS, OVERLAP)


@query("rec_ibcf", "+" + MODELS + "," + ibcf_sql("gz", "tz") + """
---
    SELECT "user", item::BIGINT AS item, predicted FROM ip WHERE predicted IS NOT NULL""", ("ratings",))
def _(t):
    given, train = _given_train(t)
    return rec.ibcf(given, train, ITEMS_KEPT, OVERLAP)


@query("rec_topn", "+" + ACTIVE + "," + z_of("rz", "SELECT * FROM r") + "," + ubcf_sql("rz", "rz") + f"""
---
    SELECT "user", item, rank FROM ({ranked_sql('up')}) WHERE rank <= 5""", ("ratings",))
def _(t):
    """Five unseen items for every user, neighbours taken from all other users."""
    ratings = materialize(active(t), "active")
    return rec.top_n(rec.ubcf(ratings, ratings, NEIGHBOURS, OVERLAP), 5).select("user", "item", F.col("rank").cast("bigint").alias("rank"))


@query("rec_eval_topn", "+" + EVAL + """
---
    SELECT * FROM rates""", ("ratings",))
def _(t):
    return rec.evaluate(active(t), rec.split_fold(75), [0], NS, NEIGHBOURS, ITEMS_KEPT)


FOLD = BUCKET.format(key='{}."user"', n=5)
FOLDS = ACTIVE + f""",
    w AS (SELECT "user", arg_max(item, md5("user"::VARCHAR || ':' || item::VARCHAR)) AS out FROM r GROUP BY 1),
    roles AS (SELECT "user", item, rating, CASE WHEN item = out THEN 'withheld' ELSE 'given' END AS role FROM r JOIN w USING ("user")),""" + (
    z_of("gz", "SELECT * FROM roles WHERE role = 'given'") + "," + z_of("tz", "SELECT * FROM r") + ","
    + ubcf_sql("gz", "tz", f"{FOLD.format('g')} <> {FOLD.format('t')}") + f""",
    js AS (SELECT f, g.item AS a, t.item AS b, {COS} AS sim FROM (SELECT unnest(range(5)) AS f) JOIN tz g ON {FOLD.format('g')} <> f
           JOIN tz t ON g."user" = t."user" AND g.item <> t.item GROUP BY 1, 2, 3 HAVING count(*) >= 2),
    jn AS (SELECT * FROM js WHERE sim IS NOT NULL QUALIFY row_number() OVER (PARTITION BY f, a ORDER BY sim DESC, b) <= 30),
    ip AS ({BACK} FROM (SELECT g."user", jn.a AS item, sim, g.z, mean, sd FROM gz g JOIN jn ON g.item = jn.b AND jn.f = {FOLD.format('g')}) p
           WHERE NOT EXISTS (SELECT 1 FROM gz s WHERE s."user" = p."user" AND s.item = p.item) GROUP BY 1, 2),
    e AS ({eval_sql('ubcf', 'up')} UNION ALL {eval_sql('ibcf', 'ip')}),
    rates AS (SELECT {RATES} FROM e)""")


@query("rec_eval_kfold", "+" + FOLDS + """
---
    SELECT * FROM rates""", ("ratings",))
def _(t):
    """The same evaluation by five-fold cross-validation over users."""
    return rec.evaluate(active(t), rec.k_fold(5), [0, 1, 2, 3, 4], NS, NEIGHBOURS, ITEMS_KEPT)


@query("rec_model_compare", "+" + EVAL + """
---
    SELECT algorithm, n, tpr, fpr, algorithm = (SELECT algorithm FROM rates GROUP BY 1 ORDER BY round(avg(tpr - fpr), 6) DESC, algorithm DESC LIMIT 1) AS chosen FROM rates""", ("ratings",))
def _(t):
    """Points of both curves, and the model with the larger mean distance from the diagonal."""
    points = rec.evaluate(active(t), rec.split_fold(75), [0], NS, NEIGHBOURS, ITEMS_KEPT).select("algorithm", "n", "tpr", "fpr")
    # two algorithms times six list lengths
    gap = F.round(F.avg(F.col("tpr") - F.col("fpr")).over(Window.partitionBy("algorithm")), 6)
    best = F.max(F.struct("gap", "algorithm")).over(Window.partitionBy())
    return points.withColumn("gap", gap).withColumn("chosen", F.col("algorithm") == best["algorithm"]).drop("gap")
