"""Operators 9 and 10, the pipeline and the registered queries."""

import collections
import random
import sys

import pytest
from corpus_fixtures import documents, mixed_texts  # noqa: F401
from pyspark.sql import functions as F

import compare
import corpus_pipeline
from tidemark.llm import extract, queries, toxicity

# --- 9 ---------------------------------------------------------------------------------------

PROSE = "The man who was in the house of the king and all the others were there for the day and the night"


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("<html><body></body></html>", ""),
        (f"<p>{PROSE}", PROSE),
        (f"<nav><a href=x>Home</a></nav><article><h1>Title</h1><p>{PROSE}.<p>Short.</article><footer>&copy; x</footer>", f"Title\n{PROSE}.\nShort."),
        (f"<article><p>a &lt;b&gt; &amp;amp;\n\t c&nbsp;d</p><script>var x='</p>'</script><!-- <p>no</p> --><p>{PROSE}</article>", f"a <b> &amp; c d\n{PROSE}"),
        (f"<body><div><a href=a>One</a> | <a href=b>Two</a></div><div><p>{PROSE}.</p><p>Yes.</p><p>{PROSE}!</p></div><div>Copyright</div>", f"{PROSE}.\nYes.\n{PROSE}!"),
        (f"<article><p>{PROSE}</p><div class='share-box'>Share this</div><form><input>Mail</form><div id=comments><p>{PROSE}?</p></div></article>", PROSE),
        (f"<nav><ul><li>Menu<article><p>{PROSE}</article>", PROSE),
        (f"<article><p>{PROSE}<br>next line<br><br>new block</article>", f"{PROSE} next line\nnew block"),
        (f"<aside>{PROSE}</aside><main><header><h1>Head</h1></header><p>{PROSE}</p></main>", f"Head\n{PROSE}"),
        ("<p>unclosed <b attr=\"a > b\">bold</b> & raw < sign", ""),
        (f"<!-- open comment <p>{PROSE}", ""),
    ],
)
def test_main_text(page, text):
    assert extract.main_text(page) == text


def test_extract_frame(spark):
    rows = [(1, "u", f"<article><p>{PROSE}</p></article>", "old", 5), (None, None, None, None, None), (1, "u", "<p>" + "x " * 200_000, "", 0)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    found = extract.extract(frame)
    assert found.columns == ["page_id", "url", "text", "n_chars"] and dict(found.dtypes)["n_chars"] == "bigint"
    rows = sorted(found.collect(), key=str)
    assert sorted(r.n_chars for r in rows) == sorted(len(r.text) for r in rows) and len(rows) == 3
    assert extract.extract(frame.limit(0)).collect() == []


def test_brackets_and_quotes_do_not_slow_extraction():
    assert extract.main_text("<a " * 20_000 + "\"'" * 20_000) is not None


# --- 10 --------------------------------------------------------------------------------------


def labelled(seed, count):
    rng = random.Random(seed)
    words = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    insults = ["grobol", "snarkel", "vilemutt"]
    docs, labels = [], []
    for key in range(count):
        text = [rng.choice(words) for _ in range(rng.randint(20, 120))]
        toxic = int(rng.random() < 0.25)
        for _ in range(rng.randint(2, 6) if toxic else 0):
            text[rng.randrange(len(text))] = rng.choice(insults) + rng.choice(["", "", "s", "ish"])
        docs.append((key, " ".join(text)))
        labels.append((key, rng.randint(0, 1), toxic))
    return docs, labels


def test_scores_find_toxic_texts(spark, documents):
    docs, labels = labelled(1, 700)
    odd = [(9000, None), (9001, ""), (9002, " \n"), (9003, "grobol snarkel"), (None, "plain words"), (5, docs[5][1]), (9004, "word " * 100_000)]
    frame = documents(docs + odd).withColumnsRenamed({"lang": "score", "source": "predicted"})
    known = spark.createDataFrame([*labels, (1, 0, None), (None, 1, 1), (2, 0, labels[2][2])], "doc_id long, quality int, toxic int")
    scored = toxicity.score_documents(frame, known, rounds=6)
    assert scored.columns == ["doc_id", "text", "n_chars", "score", "predicted"]
    rows = scored.withColumn("held", toxicity.remainder(F.col("doc_id")) == 2).collect()
    assert len(rows) == len(docs) + len(odd) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    truth = {key: toxic for key, _, toxic in labels}
    held = collections.Counter((truth[r.doc_id], r.predicted) for r in rows if r.held and r.doc_id in truth)
    assert held[1, 1] >= 0.9 * (held[1, 1] + held[1, 0]) and held[0, 1] <= 0.02 * (held[0, 0] + held[0, 1])
    by_id = {r.doc_id: r.predicted for r in rows}
    assert [by_id[k] for k in (9000, 9001, 9002, 9004)] == [0, 0, 0, 0] and by_id[9003] == 1


def test_scores_do_not_depend_on_held_out_labels(spark, documents):
    docs, labels = labelled(2, 300)
    schema = "doc_id long, quality int, toxic int"
    held = {r.doc_id for r in spark.createDataFrame(labels, schema).where(toxicity.remainder(F.col("doc_id")) == 2).collect()}
    turned = [(k, 1 - q, 1 - t if k in held else t) for k, q, t in labels]
    one, two = (
        {r.doc_id: r.score for r in toxicity.score_documents(documents(docs), spark.createDataFrame(x, schema), rounds=3).collect()}
        for x in (labels, turned)
    )
    assert one == two and len(held) > 30


@pytest.mark.parametrize("toxic", [None, 0, 1])
def test_without_both_classes_the_score_is_the_share(spark, documents, toxic):
    labels = [] if toxic is None else [(k, 0, toxic) for k in range(20)]
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = toxicity.score_documents(documents([(k, "some text") for k in range(20)]), known).collect()
    assert {r.score for r in rows} == {float(toxic or 0)} and len(rows) == 20
    assert toxicity.score_documents(documents([]), known).collect() == []


def test_features_of_hidden_and_near_words():
    lexicon = toxicity.Lexicon({"=idiot": 5.0, "lowei": 2.0})
    names = dict(zip(toxicity.FEATURES, toxicity.features("you are an IDIOT 1d10t! and id*ot loweichen", lexicon)))
    assert names["hidden_hits"] > 0 and names["near_second_person"] > 0 and names["shouted"] > 0
    assert names["strong_density"] > 0 and names["weak_density"] > 0
    assert toxicity.features(None, lexicon) == toxicity.features(" ", lexicon) == [0.0] * len(toxicity.FEATURES)


# --- pipeline and queries --------------------------------------------------------------------


def write(frame, folder, name):
    frame.write.parquet(f"{folder}/{name}.parquet")


def test_pipeline_decides_planted_cases(spark, documents, tmp_path):
    docs, labels = labelled(3, 400)
    rng = random.Random(4)
    fresh = lambda n: " ".join("".join(rng.choice("bcdfgaeiou") for _ in range(6)) for _ in range(n))
    passage, item, base = fresh(70), fresh(25), fresh(300)
    planted = [
        (1000, base), (1001, base), (1002, fresh(30) + "\n" + passage + "\n" + fresh(30)),
        (1003, fresh(40) + " " + passage + " " + fresh(20)), (1004, fresh(50) + " " + item + " " + fresh(50)),
        (1005, fresh(80)), (1006, None), (1007, ""),
    ]
    folder = str(tmp_path)
    write(documents(docs + planted), folder, "documents")
    write(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), folder, "labels")
    write(spark.createDataFrame([(1, item)], "item_id long, text string"), folder, "benchmark")
    done = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert 1000 in done and 1001 not in done and 1004 not in done and 1005 in done
    assert passage in done[1002].text and passage not in done[1003].text and done[1003].text.split()[:40] == planted[3][1].split()[:40]
    assert 1006 in done and 1007 not in done and done[1006].text is None
    toxic = {key for key, _, bad in labels if bad}
    assert len(toxic & set(done)) <= 0.1 * len(toxic)
    assert len(set(done) & {key for key, _, bad in labels if not bad}) >= 0.97 * (len(labels) - len(toxic))
    assert all(r.round_trip and r.n_tokens == len(r.ids) // 4 for r in done.values())


def test_stages_of_empty_tables(spark, documents, tmp_path):
    folder = str(tmp_path)
    write(documents([]), folder, "documents")
    write(spark.createDataFrame([], "doc_id long, quality int, toxic int"), folder, "labels")
    write(spark.createDataFrame([], "item_id long, text string"), folder, "benchmark")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).collect() == []
    assert corpus_pipeline.run(spark, folder).collect() == []


def test_queries_have_their_columns(spark):
    """Every query over the smallest tables: columns of its contract, a row for every document or page."""
    folder = "/root/testdata/sf0.001"
    count = spark.read.parquet(f"{folder}/documents.parquet").count()
    wanted = {
        "op1": "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string",
        "op4": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
        "op5": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
        "op6": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
        "op7": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
        "op8": "doc_id bigint, fingerprint string, component_id bigint",
        "op10": "doc_id bigint, held_out boolean, score double, predicted int",
    }
    for name, query in queries.QUERIES.items():
        if (start := name.split("_")[0]) in wanted:
            found = query(spark, folder)
            assert ", ".join(f"{c} {kind}" for c, kind in found.dtypes) == wanted[start], name
            assert found.count() == count, name


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_equal_their_sql(spark, name):
    folder = "/root/testdata/sf0.01"
    assert compare.difference(queries.QUERIES[name], queries.SQL[name], spark, compare.connect(folder), folder) is None


def test_nothing_else_imports_the_corpus_operators():
    import subprocess

    code = "import sys, tidemark.suite; sys.exit(any(m.startswith('tidemark.llm') for m in sys.modules))"
    assert subprocess.run([sys.executable, "-c", code], cwd=compare.__file__.rsplit("/tests/", 1)[0]).returncode == 0
