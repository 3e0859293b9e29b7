"""The operators of finlake.llm against brute force and planted cases."""
import os
import random
import sys
import zlib

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from finlake.llm import decontam, html_blocks, langid, mixing, quality_rules, simhash, token_files, toxicity, url_filter, warc  # noqa: E402
from finlake.llm.common import ship  # noqa: E402
from finlake.llm.oracle import oracle_sql  # noqa: E402
from finlake.llm.queries import QUERIES, tokenizer_file  # noqa: E402
from tests.conftest import SF_SMALL  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long, SIZE string, hits string, fp int, Kept int"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls everywhere, empty and long texts, ties, repeated rows, clashing names."""
    ship(spark)
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "the", "of", "Über", "中文", "x."]
    long = " ".join(rng.choice(words) for _ in range(30_000))
    rows = [(1, None, None, None, None, "a", "b", 1, 1), (None, "", "en", "s1", 0, "a", "b", 1, 1), (None, None, "en", "s1", 0, "a", "b", 1, 1),
            (2, long, "en", None, 9, "a", None, 1, 1), (2, long, "en", None, 9, "a", None, 1, 1), (3, "  \n\t ", "de", "s2", 5, "a", "b", None, None)]
    rows += [(k, " ".join(rng.choice(words) for _ in range(rng.randint(1, 80))), rng.choice(["en", "de", None]), rng.choice(["s1", "s2", None, "é"]), 1, "a", "b", 1, 1)
             for k in range(4, 40)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    ship(spark)
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    df = QUERIES[name](spark, SF_SMALL)
    want = con.execute(oracle_sql()[name])
    at = [[d[0] for d in want.description].index(c) for c in df.columns]
    value = lambda v: str(round(v, 6)) if isinstance(v, float) else str(v)
    assert sorted([value(v) for v in r] for r in df.collect()) == sorted([value(r[k]) for k in at] for r in want.fetchall())


def test_token_round_trip(spark, odd, none, tmp_dir):
    enc = token_files.encoder(tokenizer_file())
    token_files.write(odd, f"{tmp_dir}/t", tokenizer_file())
    got = token_files.read(spark, f"{tmp_dir}/t", with_ids=True).orderBy("start").collect()
    texts = sorted(((r.doc_id is not None, r.doc_id or 0), r.text or "") for r in odd.collect())
    assert [r.doc_id is None for r in got] == [not k[0] for k, _ in texts]
    at = 0
    by_id = {}
    for (_, name), text in texts:
        by_id.setdefault(name, []).append(enc.tokenizer.encode(text, add_special_tokens=False).ids + [0])
    for r in got:
        assert r.start == at and r.ids in by_id[r.doc_id or 0]
        assert r.n_tokens == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens
    assert {r.doc_id for r in token_files.read(spark, f"{tmp_dir}/t", doc_ids=[7, 9]).collect()} == {7, 9}
    token_files.write(none, f"{tmp_dir}/e", tokenizer_file())
    assert token_files.read(spark, f"{tmp_dir}/e").count() == 0


def test_pieces_equal_whole_texts():
    enc, rng = token_files.encoder(tokenizer_file()), random.Random(1)
    alphabet = [*" \n\t\r.,!?'sdl aé&#9中", "<|endoftext|>", "it's", "word", "\x85", "\x00", "!! ,"]
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14)))
        assert enc.encode(text, None) == enc._whole(text), repr(text)


def test_warc_archives(spark, tmp_dir):
    ship(spark)
    big = "<p>é\r\n\r\nContent-Length: 3\r\n\r\n</p>" * 60
    rows = [(k, "http://A.com/x", big, 5, "n") for k in range(6)] + [(9, None, None, 7, None), (None, "nourl", big, 1, "n"), (11, "http://b.org/\n", "small", 2, "n"), (12, "http://b.org/", "small", 2, "n")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, captured long, record string")
    warc.write(pages, f"{tmp_dir}/w", records_per_file=3)
    got = warc.merge_index(warc.scan(spark, f"{tmp_dir}/w")).collect()
    assert [(r.url_key, r.captured) for r in got] == sorted((r.url_key, r.captured) for r in got)
    kinds = {r.page_id: (r.record_type, r.refers_to) for r in got}
    assert kinds == {**{k: ("revisit", 5) for k in range(5)}, 5: ("response", None), None: ("revisit", 5), 9: ("response", None), 11: ("response", None), 12: ("response", None)}
    assert {r.payload_bytes for r in got if r.page_id in (0, 5)} == {len(big.encode())}


def test_loser_tree():
    rng = random.Random(2)
    for k in range(9):
        runs = [sorted((rng.randint(0, 9), i) for i in range(rng.randint(0, 6))) for _ in range(k)]
        assert list(warc.LoserTree(runs)) == sorted(x for r in runs for x in r)


def test_language(spark, odd, none):
    got = QUERIES["op3_language_profiles"](spark, SF_SMALL).toPandas()
    want = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "lang").toPandas()
    held = got[got.held_out].merge(want, on="doc_id")
    assert (held.lang_pred == held.lang).mean() > 0.9
    seen = langid.predict(odd, langid.learn(odd)).collect()
    assert {r.lang_pred for r in seen if not (r.text or "").strip()} == {"und"} and all(0 <= r.score <= 1 for r in seen)
    assert langid.learn(none) == {} and langid.predict(none, {}).count() == 0


def test_language_of_very_many(spark, odd, none):
    """No language is dropped, and blocks of languages give what all at once give."""
    ship(spark)
    letters = [chr(0x4E00 + k) for k in range(1010)]
    docs = spark.createDataFrame([(k, c * (1 + k % 5), f"l{k:04}") for k, c in enumerate(letters)], "doc_id long, text string, lang string")
    profiles = langid.learn(docs)
    assert len(profiles) == 1010
    assert all(r.lang_pred == r.lang and r.score == 1 for r in langid.predict(docs, profiles).collect())
    few = langid.learn(odd.withColumn("lang", F.concat(F.lit("l"), F.col("doc_id") % 9)))
    key = lambda df: sorted(map(str, df.select("doc_id", "text", "lang_pred", "score").collect()))
    assert key(langid.predict(odd, few, block=2)) == key(langid.predict(odd, few)) and len(few) == 9
    assert langid.predict(none, few, block=2).count() == 0


def test_language_of_long_texts(monkeypatch):
    """Texts counted in pieces of any size have the n-grams of the whole."""
    rng = random.Random(3)
    text = "".join(rng.choice("abΣσ ,İ中\n") for _ in range(200))
    whole = langid.counted([np.unique(langid.grams(langid.padded(text)), return_counts=True)])
    for size in (1, 2, 3, 7, 50, 201, 202, 203):
        monkeypatch.setattr(langid, "CHUNK", size)
        got = langid.counted([np.unique(g, return_counts=True) for g in langid.pieces(text)])
        assert all(np.array_equal(a, b) for a, b in zip(got, whole))
        order = np.argsort(-whole[1], kind="stable")
        assert np.array_equal(langid.ranking(text, 10_000), whole[0][order])


def test_mixing_near_targets(odd, none):
    got = mixing.mix(odd).toPandas()
    assert len(got) == odd.count() and "hits" in got
    for _, part in got.groupby("source", dropna=False):
        assert abs(part.taken.sum() - part.target.iloc[0]) <= part["size"].max()
    assert got.groupby("source", dropna=False).target.first().sum() == pytest.approx(1.5 * got["size"].sum())
    assert mixing.mix(none).count() == 0


def naive_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def naive_roots(values):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a in values:
        for b in values:
            if (a ^ b).bit_count() <= 3 and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {v: find(v) for v in values}


def test_simhash(spark, odd, none):
    rows = odd.collect()
    got = simhash.groups(odd).collect()
    assert sorted(r.fp & (1 << 64) - 1 for r in got) == sorted(naive_fingerprint(r.text) for r in rows)
    kept = simhash.keep_one(odd)
    assert kept.count() == len(set(naive_roots({naive_fingerprint(r.text) for r in rows}).values())) and kept.columns == odd.columns
    assert simhash.groups(none).count() == 0


@pytest.mark.parametrize("bucket", [64, 2])
def test_simhash_links(spark, bucket):
    """Chains, and buckets more crowded than are joined."""
    ship(spark)
    rng = random.Random(3)
    values = {0}
    for _ in range(3):
        v = rng.getrandbits(64)
        for _ in range(25):
            values.add(v)
            for _ in range(rng.randint(1, 4)):
                v ^= 1 << rng.randrange(64)
    fps = spark.createDataFrame([(simhash._signed(v),) for v in values], "fp long")
    got = simhash.components(simhash.links(fps, bucket)).collect()
    assert all((simhash._signed(0) == 0) for _ in got)
    groups = {}
    for r in got:
        groups.setdefault(r.root, set()).add(r.node & (1 << 64) - 1)
    want = {}
    for v, r in naive_roots(sorted(values)).items():
        want.setdefault(r, set()).add(v)
    assert {frozenset(g) for g in groups.values()} == {frozenset(g) for g in want.values() if len(g) > 1}


def test_url_rules(spark):
    urls = [None, "nothing", "http://Example.NET/en/1", "http://example.net", "https://m.example.com/de/x?y", "http://a.org/fr/", "http://b.org/de/", "x://h?q://r"]
    pages = spark.createDataFrame([(k, u, "v") for k, u in enumerate(urls)], "page_id long, url string, verdict string")
    outcomes = spark.createDataFrame([("http://b.org/", 1)] * 60 + [("http://c.com/", 0)] * 200 + [("http://c.com/", None)], "url string, bad int")
    rules = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, outcomes, rules).collect()}
    assert got[0] == ("", "", None, "allow") and got[1] == ("", "", None, "allow")
    assert got[2] == ("example.net", "/en/1", "example.net/en/", "allow") and got[3][2] is None
    assert got[4][2:] == ("example.com/de/", "block") and got[5][2:] == ("org/fr/", "allow") and got[6][2:] == (None, "block")
    assert got[7][:2] == ("h", "")
    assert url_filter.judge(pages.limit(0), outcomes.limit(0), rules).count() == 0


def test_url_posterior(spark):
    """The posterior tail against a power series, over sizes; suffixes by
    parameter; a strength learned from scattered and from equal hosts."""
    import math

    def below(x, a, b):
        n = 400 + math.ceil(20 * math.sqrt(a + b)) + 2 * max(0, math.ceil((b * x - a * (1 - x)) / (1 - x)))
        lead = -math.lgamma(b) + a * math.log(x) + b * math.log(1 - x)
        return math.fsum(math.exp(math.lgamma(a + b + j) - math.lgamma(a + 1 + j) + j * math.log(x) + lead) for j in range(n))

    sizes = [(a * n, (1 - a) * n) for a in (0.002, 0.05, 0.24, 0.25, 0.27, 0.6, 0.99) for n in (1.5, 20.0, 300.0, 50_000.0)]
    rows = spark.createDataFrame(sizes, "a double, b double").withColumn("p", url_filter.beta_below(0.25, F.col("b"), F.col("a"))).collect()
    assert [(r.a, r.b) for r in rows if abs(r.p - below(0.25, r.a, r.b)) > 1e-6] == []

    names = ["a.b.co.uk", "b.co.uk", "co.uk", "x.y.github.io", "y.github.io", "x.gob.es", "h", "", "m.x.com:80"]
    model = url_filter.Reputation(suffixes=("github.io",))
    domain, suffix = url_filter.domain_parts(F.col("h"), model)
    got = [(r.d, r.s) for r in spark.createDataFrame([(n,) for n in names], "h string").select(domain.alias("d"), suffix.alias("s")).collect()]
    assert got == [("b.co.uk", "co.uk"), ("b.co.uk", "co.uk"), ("co.uk", "uk"), ("y.github.io", "github.io"), ("y.github.io", "github.io"),
                   ("x.gob.es", "gob.es"), ("h", "h"), ("", ""), ("x.com", "com")]

    def mean(outcomes):
        labels = spark.createDataFrame([(f"http://{h}/", b) for h, bad, n in outcomes for b in [1] * bad + [0] * (n - bad)], "url string, bad int")
        pages = spark.createDataFrame([("http://new.a.com/",), ("http://few.a.com/",)], "url string")
        return {r.host: r.bad_mean for r in url_filter.judge(pages, labels).collect()}

    equal = mean([(f"h{k}.a.com", 5, 50) for k in range(20)] + [("few.a.com", 2, 3)])
    apart = mean([(f"h{k}.a.com", 50 * (k % 10 == 0), 50) for k in range(20)] + [("few.a.com", 2, 3)])
    assert abs(equal["new.a.com"] - 0.1) < 0.02 and equal["few.a.com"] < 0.2  # hosts alike: the prior is worth much
    assert apart["few.a.com"] > 0.4                                         # hosts apart: it is worth little


def test_severity(spark, odd, none):
    rows = [(k, f"word{k % 7} " + ("vile " if g else "") + ("rotten " if g > 1 else "") + "plain text", g) for k in range(300) for g in [k % 10 // 8 * (1 + k % 2)]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, grade int")
    model = toxicity.train(docs)
    got = toxicity.score(docs, model).toPandas()
    assert (got.toxic == (got.grade > 0)).all() and list(model.thresholds) == sorted(model.thresholds)
    assert got[got.grade == 2].severity.mean() > got[got.grade == 1].severity.mean() > got[got.grade == 0].severity.mean()
    assert toxicity.score(odd, model).count() == odd.count() and toxicity.score(none, model).count() == 0
    assert toxicity.train(docs.limit(0)).thresholds == ()


def test_quality_odd_rows(odd, none):
    got = quality_rules.judge(odd).toPandas()
    assert len(got) == odd.count() and not got[got.n_words < 10].kept.any()
    assert quality_rules.judge(none).count() == 0


def test_helper_names_of_the_operators_may_be_columns(spark, odd):
    """Extra columns with the names of every helper column come back as they were."""
    import inspect
    import re as regex

    for module, run, keep in ((quality_rules, quality_rules.judge, quality_rules.keep), (mixing, mixing.mix, mixing.repeat)):
        own = {"size", "source_size", "target", "copies", "taken", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
               "char_jsd", "word_jsd", "base_failed", "kept"}
        names = set(regex.findall(r"[\"']`?(_?[a-z][a-z_0-9]*)`?[\"']", inspect.getsource(module))) | {"rounds", "0", "1", "a.b", "_Words"}
        names -= {"text", "lang", "source", "doc_id", "left", "bigint"} | own
        seen = set()
        names = [n for n in sorted(names) if not (n.lower() in seen or seen.add(n.lower()))]
        docs = odd.select("doc_id", "text", "lang", "source", *[F.concat(F.lit(f"{n} "), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(n) for n in names])
        for out in (run(docs), keep(docs)):
            for r in out.collect():
                assert all(r[n] == f"{n} {'-' if r.doc_id is None else r.doc_id}" for n in names)
        plain = run(odd.select("doc_id", "text", "lang", "source"))
        columns = [c for c in plain.columns if c in own or c == "doc_id"]
        assert sorted(map(str, run(docs).select(*columns).collect())) == sorted(map(str, plain.select(*columns).collect()))


def test_long_and_hostile_pages():
    import time

    for unit, n in (("<div></p>", 60_000), ("<b></i>", 80_000), ("<p><td></p><div>", 30_000), ("<li><ul></dd>", 40_000), ("<a href='", 100_000), ("<h1><span>", 60_000)):
        start = time.time()
        html_blocks.blocks(unit * n + "end")
        assert time.time() - start < 8, unit
    page = "<p>" + "word " * 400_000 + "</p>"
    assert html_blocks.blocks(page)[0][1] == 400_000


def test_severity_sample_and_counts(spark):
    rng = random.Random(8)
    rows = [(k, " ".join(rng.choice(["a", "bb", "ccc", "dd"]) for _ in range(5)) + (" vile" if k % 3 == 0 else ""), int(k % 3 == 0)) for k in range(3000)]
    docs = spark.createDataFrame(rows + [(9000, None, 0), (9001, "", 1), (None, "a vile", 1), (9002, "zzz", None)], "doc_id long, text string, grade int").repartition(4)
    small = toxicity.train(docs, max_rows=300)
    assert small.weights and max(small.weights, key=small.weights.get) == "vile"
    got = toxicity.score(docs, small).filter("text is not null and text <> ''").toPandas()
    assert (got.toxic == got.text.str.contains("vile")).all()
    every = toxicity.train(docs, max_rows=10_000)
    naive = toxicity._fit([np.array(sorted(i for i, t in enumerate(sorted(every.weights)) if t in toxicity.terms(x)), np.int64) for _, x, _ in rows],
                          np.array([g for *_, g in rows]), len(every.weights), 2, 2e-4, 300)
    top = sorted(every.weights)[int(np.argmax(naive[0]))]
    assert top == "vile"


def test_quality_of_very_many_languages(spark, none):
    """Every language has a reference, whether Spark broadcasts them or not."""
    rng = random.Random(6)
    rows = [(k, " ".join(rng.choice(["ab", "cd", "efg", f"w{k % 7}"]) + rng.choice("xyz") for _ in range(50 + k % 3)), f"l{k}") for k in range(1010)]
    docs = spark.createDataFrame(rows + [(-1, rows[0][1], None), (-2, rows[0][1], "l0")], "doc_id long, text string, lang string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    got = []
    for limit in ("10m", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        got.append({r.doc_id: (r.char_jsd, r.word_jsd, r.kept) for r in quality_rules.judge(docs).collect()})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got[0] == got[1] and len(got[0]) == 1012
    assert [d for d, r in got[0].items() if r[1] is None] == [-1]


def test_decontamination(spark, odd, none):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(3000)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, text(30) + ". " + text(8) + ".", "x") for k in range(12)] + [(90, None, "x"), (91, "", "x"), (92, "a b", "x")]
    exact = [(k, text(100) + " " + items[k][1].upper() + " " + text(50)) for k in range(12)]
    edited = [(100 + k, text(30) + " " + " ".join(w for j, w in enumerate(items[k][1].split()) if j % 8) + " " + text(200)) for k in range(12)]
    docs = exact + edited + [(200 + k, text(300)) for k in range(40)] + [(None, None)]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string, hits string")
    ship(spark)
    found = {(r.doc_id, h.item_id) for r in decontam.search(docs, bench, decontam.Search(block=7)).collect() for h in r.hits}
    assert found == {(k, k) for k in range(12)} | {(100 + k, k) for k in range(12)}
    assert decontam.search(odd, bench).count() == odd.count() and decontam.search(none, bench).count() == 0
    assert decontam.search(odd, bench.limit(0)).columns == [c for c in odd.columns if c != "hits"] + ["hits"]


def test_decontamination_without_the_rarest_words(spark):
    """Paraphrases that replace an item's rarest words: all that the word
    check accepts at any place of a document are found."""
    rng = random.Random(9)
    common = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(6400)]  # each in a hundredth of the passages
    text = lambda n: [rng.choice(common) for _ in range(n)]
    rare = lambda ws, name: [f"{name}{j}" if j % 10 in (1, 4, 8) else w for j, w in enumerate(ws)]
    plain = [text(40) for _ in range(12)]
    items = [rare(ws, f"rare{k}x") for k, ws in enumerate(plain)]
    bench = [(k, " ".join(ws[:30]) + ". " + " ".join(ws[30:]) + ".") for k, ws in enumerate(items)]
    docs = [(k, " ".join(text(100 + k) + rare(ws, f"other{k}x") + text(120))) for k, ws in enumerate(plain)]
    docs += [(100 + k, " ".join(text(300))) for k in range(40)]
    s = decontam.Search()
    want = set()
    for d, t in docs:
        ws = decontam.text_words(t)
        for k, b in bench:
            item, answer = decontam.text_words(b), decontam.answer_words(b)
            for at in range(0, len(ws) - len(item) + 1):
                near = ws[at:at + len(item)]
                ratio = decontam.lcs(decontam.masks(item), len(item), near) / len(item)
                if ratio >= s.copy or ratio >= s.paraphrase and decontam.lcs(decontam.masks(answer), len(answer), near) / len(answer) >= s.answer:
                    want.add((d, k))
    assert want == {(k, k) for k in range(12)}
    ship(spark)
    found = decontam.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string"))
    assert {(r.doc_id, h.item_id) for r in found.collect() for h in r.hits} == want


def test_main_text(spark):
    ship(spark)
    page = """<html><head><title>T</title><script>var a="</p>"</script></head><body><nav><ul><li><a href=/x>Menu</a></ul></nav><header>Site</header>
    <div class="cookie-notice">We use cookies on this fine site of ours</div><article><h1>Head &amp; line</h1><p><b>First long paragraph, with <a href=y>a link</a>
    and quite some more words to read, so many that nobody would take it for a menu at all.<br><p>Short.<aside>Aside of words here</aside><p>Last &lt;one&gt; of the paragraphs
    in this article, again of some length so that it looks like what it is.</p></article><div id="comments"><p>I do not agree with any of this, said a reader</div>
    <form>Name <input><button>Send</button></form><footer>&copy; someone"""
    pages = spark.createDataFrame([(1, "u", page), (2, None, None), (3, "u", ""), (1, "u", page)], "page_id long, url string, html string")
    got = {r.page_id: r for r in html_blocks.extract(pages).collect()}
    lines = got[1].text.split("\n")
    assert lines[0] == "Head & line" and lines[2] == "Short." and lines[3].startswith("Last <one>") and len(lines) == 4
    assert got[2].text == got[3].text == "" and got[1].n_chars == len(got[1].text)
    assert html_blocks.extract(pages.limit(0)).count() == 0


def test_main_text_named_elements(spark):
    """The class of a block's own element counts, until that element ends."""
    ship(spark)
    long = "word " * 30
    page = f"""<article><h1 class="page-header">Head</h1><p>First {long}<p class="advert">Buy {long}<p>Second {long}
    <p class="notice">Note {long}</p><div>Third {long}</div><p><span class="sponsored">Paid {long}</span></p><p>Fourth <span class="ad">x</span> {long}</p>
    <ul><li class="promo">Offer {long}<li>Fifth {long}</ul><table><tr><td class="ads">Ad {long}<td>Sixth {long}<tr><td>Seventh {long}</table><p>Last {long}</article>"""
    hints = {b[0].split()[0]: b[5] for b in html_blocks.blocks(page)}
    hinted = {"Buy", "Note", "Paid", "Offer", "Ad"}
    assert {w for w, h in hints.items() if h} == hinted
    pages = spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")
    kept = {line.split()[0] for line in html_blocks.extract(pages).first().text.split("\n")}
    assert kept == set(hints) - hinted


def test_main_text_plain_elements(spark):
    """Without class names word counts and links of the neighbours decide;
    linked paragraphs stay, inside an article element and out of it."""
    ship(spark)
    page = f"""<html><body><div><a href=1>Home</a> <a href=2>News</a> <a href=3>Sport</a></div><div>We use cookies to make this site better for you.</div>
    <h1>The title of it all</h1><div>First {"word " * 40}</div><div>Short line.</div><div>Linked <a href=4>{"link " * 8}</a> and {"rest " * 20}</div><div>Last {"fin " * 30}</div>
    <div>I do not agree with any of this, said a reader.</div><div>Copyright 2024 by the owners</div></body></html>"""
    inside = f"""<div>Unnamed {"line " * 30}</div><article><h1>Title</h1><p>See also <a href=x>another story of ours</a></p><p><a href=y>Linked whole</a></p>
    <p>Text {"word " * 60}</p><aside>Aside {"word " * 40}</aside><p>End.</p></article><div>A reader wrote {"much " * 25}</div>"""
    pages = spark.createDataFrame([(1, "u", page), (2, "u", inside), (3, "u", "<p>Only this")], "page_id long, url string, html string")
    got = {r.page_id: [line.split()[0] for line in r.text.split("\n")] for r in html_blocks.extract(pages).collect()}
    assert got == {1: ["The", "First", "Short", "Linked", "Last"], 2: ["Title", "See", "Linked", "Text", "End."], 3: ["Only"]}


def test_main_text_tree(spark):
    """Whatever the counts: blocks of an article stay, marked ones go."""
    import itertools

    tree = html_blocks.train(spark)

    def judged(x):
        node = tree
        while isinstance(node, tuple):
            node = node[2] if x[node[0]] <= node[1] else node[3]
        return node

    sizes, shares = (0, 3, 15, 200), (0, 0.5, 1)
    for near in itertools.product(sizes[1:], shares, sizes, shares, sizes, shares):
        for heading in (0, 1):
            assert judged((*near, 1, 0, heading, 0.0)) == 1
            assert judged((*near, 1, 1, heading, 0.0)) == judged((*near, 0, 1, heading, 0.0)) == judged((*near, 0, 0, heading, 0.5)) == 0


def test_main_text_features():
    rng = random.Random(3)
    for n in (0, 1, 2, 9):
        rows = [(rng.randint(1, 50), rng.random(), *(rng.randint(0, 1) for _ in range(4))) for _ in range(n)]
        inside = sum(r[0] for r in rows if r[2:5] == (1, 0, 0))
        for k, x in enumerate(html_blocks._features(rows)):
            by = dict(zip(html_blocks.FEATURES, x, strict=True))
            for name, at in (("words_before", k - 1), ("words_after", k + 1)):
                assert by[name] == (rows[at][0] if 0 <= at < n else 0)
                assert by[name.replace("words", "density")] == (rows[at][1] if 0 <= at < n else 0)
            assert (by["words"], by["density"], by["article"], by["heading"]) == (*rows[k][:3], rows[k][5])
            assert by["marked"] == max(rows[k][3:5])
            assert by["elsewhere"] == (0 if rows[k][2] else inside / sum(r[0] for r in rows))


def test_pipeline_stages(spark):
    """Each stage's effect on the small table, by brute force."""
    import corpus_pipeline
    from finlake.llm.common import stored, table

    docs, benchmark = table(spark, SF_SMALL, "documents"), [(r.item_id, r.text) for r in table(spark, SF_SMALL, "benchmark").collect()]
    seen = [docs.toPandas()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_SMALL), f"test-{name}")
        seen.append(docs.toPandas())
    raw, good, single, clean, mixed, tokens = seen
    assert all(list(d.columns) == list(raw.columns) for d in seen[:5])
    verdict = quality_rules.judge(table(spark, SF_SMALL, "documents")).filter("kept").toPandas()
    assert sorted(good.doc_id) == sorted(verdict.doc_id)
    prints = {d: naive_fingerprint(t) for d, t in zip(good.doc_id, good.text)}
    roots = naive_roots(set(prints.values()))
    first = {}
    for d in sorted(prints):
        first.setdefault(roots[prints[d]], d)
    assert sorted(single.doc_id) == sorted(first.values())
    leaked = {d for d, t in zip(single.doc_id, single.text)
              if any(" ".join(map(bytes.decode, decontam.text_words(b))) in " ".join(map(bytes.decode, decontam.text_words(t))) for _, b in benchmark if b)}
    assert leaked and not leaked & set(clean.doc_id) and set(clean.doc_id) <= set(single.doc_id)
    assert set(mixed.doc_id) <= set(clean.doc_id) and mixed.groupby("doc_id").size().max() <= 2
    enc = token_files.encoder(tokenizer_file())
    want = sorted((d, zlib.crc32(np.frombuffer(enc._whole(t) + b"\0\0", "<u2").astype("<u4").tobytes())) for d, t in zip(mixed.doc_id, mixed.text))
    assert sorted(zip(tokens.doc_id, tokens.ids_crc32)) == want


def test_a_word_is_compared_with_common_words_of_its_length(spark):
    rows = [(k, f"The the THE of w{k} Über über Zürich a a, 中文" * 3, lang) for k, lang in enumerate(["en", "en", "de", None])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    refs, _ = quality_rules.references(docs, quality_rules.Limits())
    for r in refs.collect():
        assert sorted(w for words in r._by_length for w in words) == sorted(r._common)
        assert all(len(w.encode()) == k for k, words in enumerate(r._by_length) for w in words)
