"""Operator 9 against pages made around known articles, and the pipeline against a brute-force version of its stages."""

import html
import random

import corpus_pipeline
from corpus_fixtures import documents  # noqa: F401
from test_search import best_distance, brute_components, plain_fingerprint
from test_substrings import removed_words
from tokenizers import Tokenizer

from tidemark.llm import decontam, extract

STOP = "the of and to in is that it was for on are as with his they at be this from have or by one had not but what all were when we there can an your which their".split()
RARE = "harbour lantern copper meadow winter engine letter garden marble signal bridge river captain village window paper mountain".split()


def sentence(rng, low=8, high=22):
    words = [rng.choice(STOP) if rng.random() < 0.55 else rng.choice(RARE) for _ in range(rng.randint(low, high))]
    return " ".join(words).capitalize() + "."


def page(rng):
    """A page and its article: paragraphs and headings between menus, asides, notices, forms, scripts, comments and footers."""
    title = " ".join(rng.choice(RARE) for _ in range(rng.randint(2, 5))).capitalize()
    blocks, parts = [title], [f"<h1>{title}</h1>"]
    for _ in range(rng.randint(3, 8)):
        text = " ".join(sentence(rng) for _ in range(rng.randint(3, 6))) + rng.choice(["", " Smith & Sons.", " 2 < 3."])
        blocks.append(text)
        shown = html.escape(text).replace(" of ", rng.choice([" of ", " <b>of</b> ", "\n\t of "]))
        parts.append(f"<p>{shown}</p>" + rng.choice(["", "<script>var a = '<p>no</p>';</script>", "<!-- <p>hidden</p> -->", "<style>p { }</style>"]))
    links = lambda n: " ".join(f"<li><a href='/{k}'>{rng.choice(RARE).capitalize()}</a></li>" for k in range(n))
    before = [f"<nav><ul>{links(6)}</ul></nav>", f"<header><a href='/'>Home</a> <a href='/in'>Sign in</a></header>", f"<div class='menu'><ul>{links(5)}</ul></div>"]
    after = [
        f"<aside><h2>More</h2><ul>{links(5)}</ul></aside>", "<form><input name='q'><button>Search</button></form>",
        f"<footer>&copy; 2024 <a href='/p'>Privacy</a></footer>", f"<div class='cookie-notice'>{sentence(rng)}</div>",
        f"<div id='comments'><p>{sentence(rng)}</p><p>{sentence(rng)}</p></div>", f"<div class='advert'><a href='/buy'>Buy now</a></div>",
    ]
    rng.shuffle(before)
    rng.shuffle(after)
    wrap = rng.choice(["<article>{}</article>", "<main>{}</main>", "<div class='content'>{}</div>", "<div>{}</div>"])
    body = "\n".join([*before[: rng.randint(1, 3)], wrap.format("\n".join(parts)), *after[: rng.randint(2, 6)]])
    return f"<!doctype html><html><head><title>{title}</title></head><body>{body}</body></html>", "\n".join(blocks)


def test_articles_of_made_pages(spark):
    rng = random.Random(12)
    pages = [page(rng) for _ in range(300)]
    frame = spark.createDataFrame([(k, "u", text) for k, (text, _) in enumerate(pages)], "page_id long, url string, html string")
    found = {r.page_id: (r.text, r.n_chars) for r in extract.extract(frame).collect()}
    assert found == {k: (article, len(article)) for k, (_, article) in enumerate(pages)}


def test_pipeline_equals_brute_force(spark, documents, tmp_path):
    """All stages after the toxic documents, which other tests hold to labels: here no label is toxic, so all pass."""
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared, items = [prose(rng.randint(45, 90)) for _ in range(8)], [prose(rng.randint(8, 20)) for _ in range(6)]
    texts = []
    for key in range(70):
        parts = [rng.choice(shared) if rng.random() < 0.4 else prose(rng.randint(10, 80)) for _ in range(rng.randint(1, 4))]
        if rng.random() < 0.2:
            parts.insert(1, rng.choice(items).upper() + ("" if rng.random() < 0.5 else "x"))
        texts.append((key, rng.choice([" ", "\n", "  "]).join(parts)))
    for key in range(70, 90):
        copied = texts[rng.randrange(70)][1]
        texts.append((key, copied if rng.random() < 0.5 else copied + " " + word()))
    texts += [(90, ""), (91, None), (92, "one two"), (None, texts[3][1]), (5, texts[5][1])]
    rng.shuffle(texts)
    folder = str(tmp_path)
    documents(texts).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(k, 1, 0) for k in range(0, 90, 3)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")

    root, first = brute_components({plain_fingerprint(text) for _, text in texts}, 2), {}
    for key, text in sorted(texts, key=lambda row: (row[0] is None, row[0] or 0)):
        first.setdefault(root[plain_fingerprint(text)], (key, text))
    kept = []
    left = list(first.values())
    for (key, text), (words, mask) in zip(left, removed_words(left, 50)):
        kept.append((key, text, " ".join(w for w, gone in zip(words, mask) if not gone), any(mask)))
    wanted = {}
    for key, text, rest, cut in kept:
        form = decontam.plain(rest)
        if not any(best_distance(decontam.plain(item), form) <= decontam.budget(len(decontam.plain(item))) for item in items if form):
            wanted[key] = (rest, text, cut)
    done = corpus_pipeline.run(spark, folder).collect()
    tokenizer = Tokenizer.from_file(corpus_pipeline.public_tokenizers.path("byte_bpe_50k.json"))
    assert {row.doc_id for row in done} == wanted.keys() and len(done) == len(wanted)
    assert len(wanted) < len(kept) < len(texts) and any(cut for _, _, cut in wanted.values())
    for row in done:
        rest, text, cut = wanted[row.doc_id]
        assert " ".join((row.text or "").split()) == rest and (cut or row.text == text)
        ids = tokenizer.encode(row.text or "", add_special_tokens=False).ids
        assert [int.from_bytes(row.ids[k : k + 4], "little") for k in range(0, len(row.ids), 4)] == ids and row.n_tokens == len(ids)
