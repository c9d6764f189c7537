"""Page extraction and review text queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallygrain.operators import markup, text as tx
from tallygrain.operators.markup import Node
from tallygrain.plans.registry import query

NODES = {"title": Node("title"), "h1": Node("h1"), "p": Node("p"), "link": Node("a", attribute="href"), "time": Node("time", attribute="datetime")}
# The review layout on the test pages: navigation links carry label and value pairs.
FIELDS = {"Summary": NODES["h1"], "Date": NODES["time"], "Pros": NODES["p"], "Cons": Node("div", "ad")}
BLOCK, LABEL, VALUE = Node("nav"), Node("a"), Node("a", attribute="href")
CATEGORIES = {"Nicht": "Nicht", "la": "la", "The": "The", "und": "und", "que": "que"}

# The same nodes in SQL, written apart from the reader. A paragraph has no end tag of its own where the next block begins.
BODY = "regexp_replace(html, '(?s)<!--.*?-->|<script.*?</script>|<style.*?</style>', '', 'g')"
STOP_AT = "(?s)^(.*?)(?:</?(?:p|div|article|section|ul|ol|table|nav|aside|footer|header|form|body|html|h[1-6]|blockquote|pre|main)\\b|$)".replace("\\\\", "\\")
LISTS = {
    "title": f"regexp_extract_all({BODY}, '(?s)<title>(.*?)</title>', 1)",
    "h1": f"regexp_extract_all({BODY}, '(?s)<h1[^>]*>(.*?)</h1>', 1)",
    "p": f"list_transform(string_split_regex({BODY}, '<p(?: [^>]*)?>')[2:], lambda part: regexp_extract(part, '{STOP_AT}', 1))",
    "link": f"""regexp_extract_all({BODY}, '<a [^>]*href="([^"]*)"', 1)""",
    "time": f"""regexp_extract_all({BODY}, '<time [^>]*datetime="([^"]*)"', 1)""",
    "ad": f"""regexp_extract_all({BODY}, '(?s)<div class="ad">(.*?)</div>', 1)""",
    "nav": f"regexp_extract_all({BODY}, '(?s)<nav>(.*?)</nav>', 1)",
}

STOP = "(" + ", ".join(f"'{w}'" for w in tx.STOP_WORDS) + ")"


def words_sql(c: str) -> str:
    return f"regexp_extract_all(lower({c}), '{tx.TOKEN}')"


def plain_sql(c: str) -> str:
    text = f"regexp_replace({c}, '<[^>]*>', '', 'g')"
    for entity, character in tx.ENTITIES.items():
        quoted = entity.replace("'", "''"), character.replace("'", "''")
        text = f"replace({text}, '{quoted[0]}', '{quoted[1]}')"
    return f"trim({text}, ' ')"


@query("txt_extract_nodes", " UNION ALL ".join(
    f"""SELECT page_id, '{n}' AS node, i - 1 AS pos, {plain_sql('m[i]')} AS text FROM (
        SELECT page_id, m, unnest(range(1, len(m) + 1)) AS i FROM (SELECT page_id, {LISTS[n]} AS m FROM pages))""" for n in NODES))
def _(t):
    nodes = markup.nodes_of(t.pages, "page_id", "html", NODES)
    return nodes.withColumn("pos", F.col("pos").cast("bigint"))


LOOKUP = ", ".join(f"v[list_position(l, '{w}')] AS {c}" for c, w in CATEGORIES.items())
PAIRS = f"""(SELECT page_id, list_transform(regexp_extract_all(b, '(?s)<a[^>]*>(.*?)</a>', 1), lambda x: {plain_sql('x')}) AS l, regexp_extract_all(b, '<a [^>]*href="([^"]*)"', 1) AS v
             FROM (SELECT page_id, unnest(CASE WHEN len({LISTS['nav']}) > 0 THEN {LISTS['nav']} ELSE [NULL] END) AS b FROM pages))"""


@query("txt_subratings", f"SELECT page_id, {LOOKUP} FROM {PAIRS}")
def _(t):
    """Values by label from the pairs of each block."""
    return markup.ratings_of(t.pages, "page_id", "html", BLOCK, LABEL, VALUE, CATEGORIES).drop("block")


FIELD_LISTS = {"Summary": LISTS["h1"], "Date": LISTS["time"], "Pros": LISTS["p"], "Cons": LISTS["ad"]}


@query("txt_reviews_table", f"""+
    n AS (SELECT page_id, {', '.join(f'{x} AS {c}' for c, x in FIELD_LISTS.items())} FROM pages),
    s AS (SELECT page_id, {LOOKUP} FROM {PAIRS}),
    i AS (SELECT *, unnest(range(1, greatest({', '.join(f'len({c})' for c in FIELDS)}, 1) + 1)) AS i FROM n)
---
    SELECT page_id, i - 1 AS pos, {', '.join(f"{plain_sql(f'i.{c}[i]')} AS {c}" for c in FIELDS)},
           {', '.join(f'CASE WHEN i = 1 THEN s.{c} END AS {c}' for c in CATEGORIES)} FROM i LEFT JOIN s USING (page_id)""")
def _(t):
    table = markup.reviews_of(t.pages, "page_id", "html", FIELDS, BLOCK, LABEL, VALUE, CATEGORIES)
    return table.withColumn("pos", F.col("pos").cast("bigint"))


RATED = ["WorkLifeBalance", "CultureValues", "CareerOpportunities", "CompBenefits", "SeniorManagement"]


@query("txt_review_pages", f"""
    SELECT doc_id, 0::BIGINT AS pos, trim(regexp_extract(text, '^[^\\n]*'), ' ') AS "Summary", strftime(DATE '2018-01-01' + (doc_id % 365)::INT, '%Y-%m-%d') AS "Date",
           (1 + doc_id % 5)::VARCHAR AS "OverallRating", CASE WHEN doc_id % 2 = 0 THEN trim(text, ' ') ELSE '' END AS "Pros", CASE WHEN doc_id % 2 = 1 THEN trim(text, ' ') ELSE '' END AS "Cons",
           {', '.join(f'CASE WHEN (doc_id + {k}) % 3 > 0 THEN (1 + (doc_id + {k}) % 5)::VARCHAR END AS "{c}"' for k, c in enumerate(RATED))}
    FROM documents WHERE text IS NOT NULL""".replace("\\\\", "\\"))
def _(t):
    """Documents rendered in the review layout, one review a page with up to five ratings, and read back."""

    def escaped(c):
        return F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))

    def rating(k, name):
        there = (F.col("doc_id") + k) % 3 > 0
        shown = F.concat(F.lit(f'<li><div class="minor">{name.replace("&", "&amp;")}</div><span class="gdBars gdRatings med " title="'), (1 + (F.col("doc_id") + k) % 5).cast("string"), F.lit('"></span></li>'))
        return F.when(there, shown).otherwise(F.lit(""))

    day = F.date_format(F.date_add(F.lit("2018-01-01").cast("date"), (F.col("doc_id") % 365).cast("int")), "yyyy-MM-dd")
    text, side = F.col("text"), F.col("doc_id") % 2
    page = F.concat(
        F.lit('<html><body><div><span class="summary">'), escaped(F.regexp_extract(text, r"^[^\n]*", 0)), F.lit('</span><time class="date subtle small" datetime="'), day,
        F.lit('">x</time><span class="value-title" title="'), (1 + F.col("doc_id") % 5).cast("string"), F.lit('"></span><div class="subRatings module"><ul>'),
        *[rating(k, c) for k, c in enumerate(markup.REVIEW_CATEGORIES.values())],
        F.lit('</ul></div><p class=" pros mainText truncateThis wrapToggleStr">'), F.when(side == 0, escaped(text)).otherwise(F.lit("")),
        F.lit('<p class=" cons mainText truncateThis wrapToggleStr">'), F.when(side == 1, escaped(text)).otherwise(F.lit("")), F.lit("</div></body></html>"),
    )
    pages = t.documents.where(text.isNotNull()).select("doc_id", page.alias("html"))
    return markup.review_rows(pages, "doc_id").withColumn("pos", F.col("pos").cast("bigint"))


@query("txt_clean_tokens", f"""
    SELECT doc_id, array_to_string(list_filter({words_sql('review')}, lambda x: x NOT IN {STOP}), ' ') AS words FROM reviews""", ("reviews",))
def _(t):
    return t.reviews.select("doc_id", F.array_join(tx.tokens(F.col("review")), " ").alias("words"))


DOC_TERM = f"""
    o AS (SELECT doc_id, unnest({words_sql('review')}) AS term FROM reviews),
    c AS (SELECT doc_id, term, count(*) AS tf FROM o WHERE term NOT IN {STOP} GROUP BY 1, 2),
    k AS (SELECT term, count(*) AS df FROM c GROUP BY 1 HAVING count(*) >= 2 AND count(*) <= 0.8 * (SELECT count(*) FROM reviews))"""


@query("txt_doc_term", "+" + DOC_TERM + """
---
    SELECT doc_id, term, tf, df FROM c JOIN k USING (term)""", ("reviews",))
def _(t):
    return tx.doc_term(t.reviews, "doc_id", "review")


@query("txt_vocab_sample", "+" + DOC_TERM + """
---
    SELECT term FROM k ORDER BY md5(term), term LIMIT 10""", ("reviews",))
def _(t):
    return tx.vocabulary_sample(tx.doc_term(t.reviews, "doc_id", "review"))


_FITS: dict[tuple, tuple] = {}


def fitted(t):
    """The topics of all reviews, fitted once in a session and folder; the three queries read the same tables."""
    name = (t.spark.sparkContext.applicationId, t.sf_dir)
    if name not in _FITS:
        _FITS[name] = tx.topic_model(t.reviews, "doc_id", "review")
    return _FITS[name]


@query("txt_lda")
def _(t):
    """Topic weights of every document."""
    _, model, documents = fitted(t)
    return tx.topic_weights(model, documents, "doc_id")


@query("txt_topic_words")
def _(t):
    vocabulary, model, _ = fitted(t)
    return tx.topic_words(model, vocabulary)


@query("txt_assign_topic")
def _(t):
    _, model, documents = fitted(t)
    return tx.assign_topic(model, documents, "doc_id")


@query("txt_word_frequency", " UNION ALL ".join(
    f"""SELECT * FROM (SELECT '{c}' AS side, term, count(*) AS n FROM (SELECT unnest({words_sql(c)}) AS term FROM reviews)
        WHERE term NOT IN {STOP} GROUP BY term ORDER BY n DESC, term LIMIT 5000)""" for c in ["pros", "cons"]), ("reviews",))
def _(t):
    return tx.word_frequency(t.reviews, ["pros", "cons"])
