"""Operators against brute force on small fixtures, exact round trips and held-out accuracy."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallygrain.llm import graph, kmeans_tree, line_dedup, mixing, packing, queries, quality_rules, simhash_dedup, url_filter, warc, wrapper_induction
from tallygrain.llm.common import ready

@pytest.fixture(autouse=True)
def settings(spark):
    ready(spark)


FOLDER = "/root/testdata/sf0.01"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(text, times, rng):
    out = list(text)
    for _ in range(times):
        at = rng.randrange(len(out))
        out[at : at + 1] = rng.choice([[], [rng.choice("abé")], [out[at], "x"]])
    return "".join(out)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_banded_distance(spark, edits):
    rng = random.Random(edits)
    rows = []
    for _ in range(600):
        a = "".join(rng.choice("abcd") for _ in range(rng.randint(8, 24)))
        rows.append((a, edited(a, rng.randint(0, edits + 3), rng)))
    rows = [(a, b) for a, b in rows if abs(len(a) - len(b)) <= edits]
    frame = spark.createDataFrame(rows, "a string, b string")
    got = frame.select("a", "b", line_dedup.bounded_distance(F.col("a"), F.col("b"), edits).alias("d")).collect()
    assert all(min(r["d"], edits + 1) == min(distance(r["a"], r["b"]), edits + 1) for r in got)


@pytest.mark.parametrize("pairs_per_key", [4096, 4])
def test_edit_join_loses_no_pair(spark, pairs_per_key):
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(22, 30))) for _ in range(15)]
    lines = sorted({edited(rng.choice(base), rng.randint(0, 3), rng).strip() for _ in range(250)})
    docs = spark.createDataFrame([(i, "\n".join(lines[i * 5 : i * 5 + 5])) for i in range(len(lines) // 5 + 1)], "doc_id long, text string")
    seen = line_dedup.lines_of(docs)
    names = {r["i"]: r["line"] for r in seen.select(F.concat(F.hex("h"), F.lit("-"), F.hex("g")).alias("i"), "line").collect()}
    long = [x for x in lines if len(x) >= line_dedup.MIN_CHARS]
    expected = {(a, b) for i, a in enumerate(long) for b in long[i + 1 :] if 0 < distance(a, b) <= 2}
    got = {tuple(sorted((names[r["a"]], names[r["b"]]))) for r in line_dedup.edit_join(seen, pairs_per_key=pairs_per_key).collect()}
    assert got == expected and expected


def test_lines_keep_their_first_place(spark):
    line, near, other = "a line that many documents share", "a line that many documents shared", "another line that stands alone"
    docs = spark.createDataFrame([(3, near + "\n" + other), (1, "short\n" + line), (2, line + "\nshort"), (4, near)], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in line_dedup.without_repeats(docs).collect()}
    assert got == {1: "short\n" + line, 2: "short", 3: other}


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000, i) for i in range(1001, 1200)] + [(i, i + 1) for i in range(2000, 2100)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}


def test_fingerprints_link_within_three_bits(spark):
    rng = random.Random(2)
    centre = [rng.getrandbits(64) for _ in range(12)]
    prints = sorted({c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for c in centre for _ in range(40)})
    frame = spark.createDataFrame([(simhash_dedup._signed(p),) for p in prints], "fp long")
    label = {p: p for p in prints}
    while True:
        new = {p: min(label[q] for q in prints if (p ^ q).bit_count() <= 3) for p in prints}
        if new == label:
            break
        label = new
    classes = {}
    for p, root in label.items():
        classes.setdefault(root, set()).add(simhash_dedup._signed(p))
    expected = sorted(sorted(c) for c in classes.values() if len(c) > 1)
    for pairwise in (128, 1):  # 1: every bucket goes through full balls
        got = {}
        for r in graph.components(simhash_dedup.links(frame, pairwise)).collect():
            got.setdefault(r["root"], set()).add(r["node"])
        assert sorted(sorted(c) for c in got.values()) == expected


def test_fingerprint_by_definition():
    import xxhash

    assert simhash_dedup.fingerprint(None) == simhash_dedup.fingerprint(" \t\n") == 0
    assert simhash_dedup.fingerprint("One  TWO") == xxhash.xxh64_intdigest(b"one two", 42)
    words = "a É c d a É c".split()
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(5)]
    assert simhash_dedup.fingerprint(" ".join(words)) == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > 5)


def test_base_counts():
    got = quality_rules.base_counts("a b c\nx a b c\n\n \na b c\n#é|".encode())
    assert got == (11, 13, 2, 1, 9)
    assert quality_rules.base_counts(b"") == (0, 0, 0, 0, 0)


def test_frequent_lines_go_and_copies_count_once(spark):
    body = [" ".join(f"{i}w{j}" for j in range(60)) for i in range(40)]
    docs = [(i, "Menu Home\n" + b, "s") for i, b in enumerate(body)] + [(100 + i, body[0] + "\nfirst\nsecond", "s") for i in range(60)] + [(900, "menu  HOME\n" * 30 + " ".join(f"z{j}" for j in range(45)), "s")]
    got = {r["row"]["doc_id"]: r for r in quality_rules.judge(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()}
    assert got[5]["clean_text"] == body[5] and got[5]["kept"] and got[100]["kept"] and got[100]["n_words_left"] == 62
    assert not got[900]["kept"] and got[900]["n_words_left"] == 45


def test_cascade_is_exact_and_passes_agree(spark):
    universe = spark.range(4000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") % 7 == 0).alias("listed"))
    cascade = url_filter.build(universe, bits_per_key=4)
    assert len(cascade.levels) > 2
    assert universe.where(cascade.contains(F.col("key")) != F.col("listed")).count() == 0
    pages = spark.range(300).select("id", F.concat(F.lit("http://a"), F.col("id") % 50, F.lit(".b"), F.col("id") % 3, F.lit(".c/p/"), F.col("id") % 4).alias("url"))
    rules = spark.createDataFrame([(f"a{i}.b{i % 3}.c", "/p/", "block") for i in range(0, 50, 2)] + [("b1.c", "/p/1", "allow"), ("c", "/p", "block")], "host string, path string, action string")
    one = sorted(map(str, url_filter.judge(pages, rules).select("row.id", "rule", "verdict").collect()))
    many = sorted(map(str, url_filter.judge(pages, rules, max_words=20).select("row.id", "rule", "verdict").collect()))
    assert one == many


def test_chunks_and_segments(spark, tmp_path):
    rng = random.Random(4)
    payload = bytes(rng.randrange(256) for _ in range(10_000))
    assert warc.unframe_chunks(warc.frame_chunks(payload, 700)) == payload and warc.unframe_chunks(warc.frame_chunks(b"")) == b""
    assert warc.unframe_chunks(b"3;x=y\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"é{i}\r\n\r\nWARC/1.1\r\n" * i) for i in range(60)], "page_id long, url string, html string").repartition(5)
    warc.write_archives(pages, str(tmp_path / "w"), segment_bytes=100, chunk_bytes=33, records_per_file=40)
    got = {warc_id: bytes(p).decode() for warc_id, p in warc.read_archives(spark, str(tmp_path / "w")).select(warc.page_of(F.col("record_id")), "payload").collect()}
    assert got == {i: f"é{i}\r\n\r\nWARC/1.1\r\n" * i for i in range(60)}


def test_missing_segment_is_told(spark, tmp_path):
    import gzip

    block = warc._HTTP + warc.frame_chunks(b"x" * 500)
    first = [("WARC-Type", "response"), ("WARC-Record-ID", "<urn:a>"), ("WARC-Segment-Number", 1)]
    last = [("WARC-Type", "continuation"), ("WARC-Record-ID", "<urn:b>"), ("WARC-Segment-Origin-ID", "<urn:a>"), ("WARC-Segment-Number", 3), ("WARC-Segment-Total-Length", len(block))]
    (tmp_path / "part-0.warc.gz").write_bytes(gzip.compress(warc._record(first, block[:100]) + b"\r\n\r\n" + warc._record(last, block[200:]) + b"\r\n\r\n"))
    got = warc.read_archives(spark, str(tmp_path)).collect()
    assert [(r["record_id"], r["payload_bytes"], r["problem"]) for r in got] == [("urn:a", None, "segment 2 is missing")]


def test_wrappers_learn_what_is_constant(spark):
    def page(i):
        return f"<div class=x>Same on all pages</div><div class=y>Text number {i} is its own</div><section><p>Story {i}<p>and &eacute;nd {i}</section><div class=x>Imprint</div>"

    pages = spark.createDataFrame([(i, f"http://h{i % 2}.org/{i}", page(i)) for i in range(40)], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in wrapper_induction.extract(pages).collect()}
    assert got == {i: f"Text number {i} is its own Story {i} and énd {i}" for i in range(40)}


@pytest.mark.parametrize(
    "source, expected",
    [
        ("<nav>no<p>no</nav><main><header><h1>Yes</h1></header>a<b>b</b> c&amp;d<br>e<script>if (a<b) '</p>'</script></main><footer>no", "Yes ab c&d e"),
        ("<article>One<aside>no</aside><p>two<div class='ad box'>no</div><form>no</form><p>three<section id=comments>no</section></article><p>no", "One two three"),
        ("<header>no</header><p>kept &lt;i&gt; &#233; <!-- no --> x < y</p>", "kept <i> é x < y"),
        ("<ul><li>a<li>b<ul><li>c</ul></ul><table><tr><td>1<td>2</table>", "a b c 1 2"),
        ("<p>cut <b off", "cut"),
    ],
)
def test_reading_of_pages(source, expected):
    assert wrapper_induction.main_text(wrapper_induction.read_page(source), None, frozenset()) == expected


def test_tree_matching():
    assert wrapper_induction.align("0 \n1 a\n1 b\n2 c", "0 \n1 b\n2 c\n1 d") == (0, -1, 1, 2)


def test_neighbours_reach_the_recall(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = frame.toPandas()
    matrix, ids = np.array(rows["embedding"].tolist(), dtype=float), rows["vec_id"].to_numpy()
    unit = matrix / np.linalg.norm(matrix, axis=1)[:, None]
    got = kmeans_tree.nearest(frame).toPandas()
    hits = total = 0
    for i in np.flatnonzero(ids % 50 == 0):
        score = unit @ unit[i]
        score[i] = -2
        best = ids[np.lexsort((ids, -score))[:5]]
        mine = got[got.query_id == ids[i]].sort_values("rank")
        hits += len(set(best) & set(mine.vec_id))
        total += 5
        assert np.allclose(mine.score, [score[ids == v][0] for v in mine.vec_id], atol=1e-12) and (np.diff(mine.score) <= 0).all()
    assert hits / total >= 0.9


def test_languages_of_held_out_documents(spark):
    got = queries.QUERIES["op7_language"](spark, FOLDER).join(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out")
    right, n = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right > 0.97 and n > 100


def _check_plan(histogram, size):
    placed, sequences = packing.plan(dict(histogram), size)
    fill, seen = {}, {}
    for p in placed:
        for r in range(p.low, p.high):
            s = p.first + (r - p.low) % p.sequences
            fill[s] = fill.get(s, 0) + p.length
            assert (p.length, r) not in seen
            seen[p.length, r] = s
    assert len(seen) == sum(histogram.values()) and all(r < histogram[length] for length, r in seen)
    assert set(fill) == set(range(sequences)) and all(f <= size for f in fill.values())
    return sequences


def test_plans_place_every_piece_once():
    rng = random.Random(6)
    for _ in range(40):
        size = rng.choice([7, 16, 100, 256])
        _check_plan({rng.randint(1, size): rng.randint(1, 40) for _ in range(rng.randint(1, 14))}, size)
    many = {}
    for _ in range(20000):
        n = min(2048, int(rng.lognormvariate(6, 1)) + 1)
        many[n] = many.get(n, 0) + 1
    bound = -(-sum(k * v for k, v in many.items()) // 2048)
    assert _check_plan(many, 2048) <= 1.01 * bound
    assert _check_plan({}, 2048) == 0


def test_packing_agrees_with_the_tokenizer(spark):
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(packing.public_tokenizer())
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(150).unionByName(spark.createDataFrame([(-1, "a <|endoftext|> b  \n\n c"), (-2, "x" * 5000 + " ½²Ⅷ don't 日本\u3000語 \x1c\x85 ")], "doc_id long, text string"), allowMissingColumns=True)
    docs = docs.select("doc_id", "text").persist()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = packing.pack(docs, packing.public_tokenizer(), bucket_rows=7).toPandas()
    for doc, rows in got.groupby("doc_id"):
        ids = np.array([*slow.encode(texts[doc], add_special_tokens=False).ids, 0], "<u4")
        rows = rows.sort_values("piece")
        assert list(zip(rows.start, rows.length)) == packing.cut(len(ids))
        assert list(rows.ids_crc32) == [zlib.crc32(ids[s : s + n].tobytes()) for s, n in zip(rows.start, rows.length)]
    for _, rows in got.sort_values("offset").groupby("sequence_id"):
        assert list(rows.offset) == [0, *np.cumsum(rows.length)[:-1]] and rows.length.sum() <= 2048


def test_shortages_go_to_siblings_first(spark):
    leaves = spark.createDataFrame([("a", "x", "s1", 1, 10), ("a", "x", "s2", 1, 1000), ("a", "y", "s3", 1, 1000), ("b", "x", "s4", 1, 30)], "domain string, lang string, source string, docs long, tokens long")
    weights = spark.createDataFrame([(0, "a", 1), (0, "b", 3), (1, "x", 1), (1, "y", 1)], "level int, name string, weight long")
    got = {r["source"]: r["given"] for r in mixing.budgets(leaves, weights, 430, max_epochs=1).collect()}
    assert got == {"s4": 30, "s1": 10, "s2": 190, "s3": 200}


def test_buckets_do_not_change_the_mix(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    mixes = [sorted(map(str, mixing.mix(docs, mixing.weights_of(spark), mixing.domain_of(F.col("source")), bucket_rows=n).collect())) for n in (4096, 5)]
    assert mixes[0] == mixes[1]
