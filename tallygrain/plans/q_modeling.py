"""Attendance features, logistic model and evaluation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallygrain.functions import scalars
from tallygrain.operators import modeling as m, reshape
from tallygrain.plans.registry import query
from tallygrain.session import materialize

CUTOFFS = m.cutoffs()
CUT_LIST = "[" + ", ".join(f"{c!r}::DOUBLE" for c in CUTOFFS) + "]"
NUMBERS = ["n_words", "n_lines", "chars_per_word", "toxic"]
HOURS = "round(epoch_us(time_out - time_in) / 3600000000, 2)::DECIMAL(18,2)"
BUCKET = "('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % 100"


def hours(t):
    return m.worked_hours(t.swipes, scalars.hours_between("time_in", "time_out"), "employee")


def terms_of(frame) -> list[str]:
    """Numbers, then a dummy for each language of the data but the first."""
    return [*NUMBERS, *sorted(c for c in frame.columns if c.startswith("lang_"))]


def design(t):
    """Features of a labelled document: counts on a common scale, dummies, and the assembled vector, written once."""
    frame = reshape.dummies(t.emp.drop("source"), ["lang"])
    scaled = frame.withColumns({
        "n_words": F.col("n_words") / 100, "n_lines": F.col("n_lines") / 10,
        "chars_per_word": F.coalesce(F.try_divide(F.col("n_chars"), 100 * F.col("n_words")), F.lit(0.0)),
    })
    split = m.hash_split(scaled, "doc_id", 70)
    terms = terms_of(frame)
    return m.assemble(materialize(split, "design"), terms)


def training(t):
    return design(t).where("is_train")


@query("hr_worked_hours", f"""
    SELECT employee, count(*) AS days, sum({HOURS})::DOUBLE AS total_hours, round(sum({HOURS})::DOUBLE / count(*), 2) AS mean_hours FROM swipes GROUP BY 1""", ("swipes",))
def _(t):
    return hours(t)


@query("hr_login_variance", f"""
    SELECT employee, round(8 - round(sum({HOURS})::DOUBLE / count(*), 2), 2) AS login_variance FROM swipes GROUP BY 1""", ("swipes",))
def _(t):
    return hours(t).select("employee", F.round(m.login_variance("mean_hours"), 2).alias("login_variance"))


@query("ml_master_table", f"""
    SELECT doc_id, target, n_words, lang, toxic, days, mean_hours, round(8 - mean_hours, 2) AS login_variance FROM emp
    JOIN (SELECT employee, count(*) AS days, round(sum({HOURS})::DOUBLE / count(*), 2) AS mean_hours FROM swipes GROUP BY 1) ON employee = doc_id""", ("emp", "swipes"))
def _(t):
    """Three sources on one key, with derived columns."""
    joined = t.emp.join(hours(t), F.col("doc_id") == F.col("employee"))
    return joined.select("doc_id", "target", "n_words", "lang", "toxic", "days", "mean_hours", F.round(m.login_variance("mean_hours"), 2).alias("login_variance"))


@query("ml_split", f"SELECT doc_id, {BUCKET} < 70 AS is_train FROM labels")
def _(t):
    return m.hash_split(t.labels.select("doc_id"), "doc_id", 70)


@query("ml_logit_fit")
def _(t):
    train = training(t)
    return m.logit(train, "target", terms_of(train)).coefficients(train)


@query("ml_stepwise_aic")
def _(t):
    """Terms of the selected model with the AIC of the full and the selected one."""
    train = training(t)
    fit, path = m.step_aic(train, "target", terms_of(train))
    return fit.coefficients(train).withColumn("start_aic", F.lit(float(path[0][1])))


@query("ml_vif")
def _(t):
    train = training(t)
    return m.vif(train, m.logit(train, "target", terms_of(train)))


@query("ml_backward_pvalue")
def _(t):
    train = training(t)
    fit, removed = m.backward_p(train, "target", terms_of(train))
    return fit.coefficients(train).withColumn("removed_terms", F.lit(len(removed)))


@query("ml_predict")
def _(t):
    """Probabilities on the rows that were not trained on."""
    frame = design(t)
    fit = m.logit(frame.where("is_train"), "target", terms_of(frame))
    return fit.predict(frame.where(~F.col("is_train"))).select("doc_id", "target", F.round("score", 6).alias("score"))


CONFUSION = """
    c AS (SELECT count(*) FILTER (WHERE score >= 0.1718 AND target = 1) AS tp, count(*) FILTER (WHERE score >= 0.1718 AND target = 0) AS fp,
                 count(*) FILTER (WHERE score < 0.1718 AND target = 1) AS fn, count(*) FILTER (WHERE score < 0.1718 AND target = 0) AS tn FROM scored)"""


@query("ml_confusion", "+" + CONFUSION + """
---
    SELECT tp, fp, fn, tn, round(tp / (tp + fn), 6) AS sensitivity, round(tn / (tn + fp), 6) AS specificity, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy FROM c""",
    ("scored",))
def _(t):
    table = m.confusion(t.scored, "target", "score", 0.1718)
    return table.withColumns({c: F.round(c, 6) for c in ["sensitivity", "specificity", "accuracy"]})


@query("ml_cutoff_sweep", f"""+
    k AS (SELECT unnest({CUT_LIST}) AS cutoff),
    c AS (SELECT cutoff, count(*) FILTER (WHERE score >= cutoff AND target = 1) AS tp, count(*) FILTER (WHERE score >= cutoff AND target = 0) AS fp,
                 count(*) FILTER (WHERE target = 1) AS p, count(*) FILTER (WHERE target = 0) AS n FROM k, scored GROUP BY cutoff)
---
    SELECT round(cutoff, 9) AS cutoff, round(tp / p, 6) AS sensitivity, round((n - fp) / n, 6) AS specificity, round((tp + n - fp) / (p + n), 6) AS accuracy,
           abs(tp / p - (n - fp) / n) < 0.01 AS balanced FROM c""", ("scored",))
def _(t):
    sweep = m.cutoff_sweep(t.scored, "target", "score", CUTOFFS)
    return sweep.withColumns({"cutoff": F.round("cutoff", 9), **{c: F.round(c, 6) for c in ["sensitivity", "specificity", "accuracy"]}})


ROC = """
    s AS (SELECT score, count(*) FILTER (WHERE target = 1) AS pos, count(*) FILTER (WHERE target = 0) AS neg FROM scored GROUP BY score),
    r AS (SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC) / sum(pos) OVER () AS tpr, sum(neg) OVER (ORDER BY score DESC) / sum(neg) OVER () AS fpr FROM s)"""


@query("ml_ks", "+" + ROC + "," + CONFUSION + """
---
    SELECT round((SELECT max(tpr - fpr) FROM r), 6) AS ks, round(tp / (tp + fn) + tn / (tn + fp) - 1, 6) AS ks_at_cutoff FROM c""", ("scored",))
def _(t):
    return m.ks(t.scored, "target", "score", 0.1718).select(F.round("ks", 6).alias("ks"), F.round("ks_at_cutoff", 6).alias("ks_at_cutoff"))


@query("ml_roc_auc", "+" + ROC + """,
    auc AS (SELECT sum(CASE WHEN p.score > q.score THEN 1.0 WHEN p.score = q.score THEN 0.5 ELSE 0 END * p.pos * q.neg) / (sum(p.pos * q.neg)) AS auc FROM s p, s q)
---
    SELECT score, round(tpr, 6) AS tpr, round(fpr, 6) AS fpr, round((SELECT auc FROM auc)::DOUBLE, 6) AS auc FROM r""", ("scored",))
def _(t):
    curve = m.roc_curve(t.scored, "target", "score")
    area = m.roc_auc(curve).scalar()
    return curve.select("score", F.round("tpr", 6).alias("tpr"), F.round("fpr", 6).alias("fpr"), F.round(area, 6).alias("auc"))


@query("ml_decile_lift", """+
    d AS (SELECT ntile(10) OVER (ORDER BY score DESC, doc_id)::INT AS bucket, target FROM scored),
    g AS (SELECT bucket, count(*) AS total, sum(target)::BIGINT AS totalresp FROM d GROUP BY 1)
---
    SELECT bucket, total, totalresp, sum(totalresp) OVER w::BIGINT AS cumresp, round(100 * (sum(totalresp) OVER w)::DOUBLE / sum(totalresp) OVER (), 6) AS gain,
           round(100 * (sum(totalresp) OVER w)::DOUBLE / sum(totalresp) OVER () / (bucket * 10), 6) AS cumlift FROM g WINDOW w AS (ORDER BY bucket)""".replace("OVER w::BIGINT", "OVER (ORDER BY bucket)::BIGINT"), ("scored",))
def _(t):
    lift = m.decile_lift(t.scored, "target", "score", "doc_id")
    return lift.withColumns({c: F.round(c, 6) for c in ["gain", "cumlift"]})


@query("ml_scale", """
    SELECT doc_id, round((n_chars - avg(n_chars) OVER ()) / stddev_samp(n_chars) OVER (), 6) + 0.0 AS n_chars,
           round((n_lines - avg(n_lines) OVER ()) / stddev_samp(n_lines) OVER (), 6) + 0.0 AS n_lines FROM emp""", ("emp",))
def _(t):
    scaled = m.standardize(t.emp.select("doc_id", "n_chars", "n_lines"), ["n_chars", "n_lines"])
    return scaled.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in ["n_chars", "n_lines"]})


@query("ml_target_profile", """
    SELECT 'lang' AS feature, lang AS level, count(*) AS n, round(avg(target), 6) AS rate FROM emp GROUP BY 2
    UNION ALL SELECT 'source', source, count(*), round(avg(target), 6) FROM emp GROUP BY 2
    UNION ALL SELECT 'n_chars', floor(n_chars / 1000)::BIGINT::VARCHAR, count(*), round(avg(target), 6) FROM emp GROUP BY 2
    UNION ALL SELECT 'n_words', floor(n_words / 200)::BIGINT::VARCHAR, count(*), round(avg(target), 6) FROM emp GROUP BY 2""", ("emp",))
def _(t):
    profile = m.target_profile(t.emp, "target", ["lang", "source"], {"n_chars": 1000, "n_words": 200})
    return profile.withColumn("rate", F.round("rate", 6))
