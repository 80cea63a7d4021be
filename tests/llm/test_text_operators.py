import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from test_near_dedup import brute
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm.quality_fm import THRESHOLD, features
from tidemark.llm.sentence_pieces import PieceTokenizer, encode_documents, model_path, tokenizer_of
from tidemark.llm.token_ids import tokenizer_path
from tidemark.llm.wrappers import extract_main_text, main_texts

PAGE = (
    "<html><head><title>t</title><style>p{{}}</style></head><body><nav><ul><li>Home<li>About</ul></nav>"
    "<div class='cookie-notice'>We use cookies</div><header>Site</header><article><h1>Title {0}</h1>"
    "{1}<div class='ad'>Buy</div><form><p>Your mail</p></form></article>"
    "<section id='comments'><p>First!</p></section><aside>More</aside><footer>&copy; x</footer></body></html>"
)


def test_wrappers_over_varying_pages():
    bodies = ["<p>One &amp; two.</p>", "<p>A<p>B  b<br>c", "<p>x</p><ul><li>i<li>j</ul><p>y</p>", "<p>z</p>" * 5]
    got = main_texts([PAGE.format(i, b) for i, b in enumerate(bodies)])
    assert got == [
        "Title 0\n\nOne & two.",
        "Title 1\n\nA\n\nB b c",
        "Title 2\n\nx\n\ni\n\nj\n\ny",
        "Title 3\n\nz\n\nz\n\nz\n\nz\n\nz",
    ]


def test_pages_without_an_article_element():
    page = "<body><div class='menu'>m</div><div id='x'><p>{}</p><p>" + "long text " * 20 + "</p></div></body>"
    got = main_texts([page.format(i) for i in range(3)])
    assert [g.split("\n\n")[0] for g in got] == ["0", "1", "2"]
    assert all("m" != g.split("\n\n")[0] for g in got)


def test_all_equal_main_elements_of_a_matching_page():
    part = "<article><h2>{0}</h2><p>{1}</p></article>"
    for parts in (2, 3):
        pages = [
            "<body><nav>n</nav>" + "".join(part.format(f"H{i}{k}", f"text {i} {k}") for k in range(parts)) + "</body>"
            for i in range(4)
        ]
        assert main_texts(pages) == [
            "\n\n".join(f"H{i}{k}\n\ntext {i} {k}" for k in range(parts)) for i in range(4)
        ]
    apart = "<body>{0}<div><p>between {1}</p></div>{0}</body>"
    pages = [apart.format(part.format("H", f"text {i}"), i) for i in range(3)]
    assert main_texts(pages) == [f"H\n\ntext {i}\n\nH\n\ntext {i}" for i in range(3)]


def test_text_of_every_page_is_template():
    page = "<body><article><div><p>Read our terms.</p></div><p>own text of page {0}</p><p>more {0}</p></article></body>"
    assert main_texts([page.format(i) for i in range(6)]) == [f"own text of page {i}\n\nmore {i}" for i in range(6)]
    few = main_texts([page.format(i) for i in range(2)] * 4)
    assert few == [f"Read our terms.\n\nown text of page {i}\n\nmore {i}" for i in (0, 1)] * 4
    copies = "<body><article><p>" + "one text " * 9 + "</p><p>{}</p></article></body>"
    assert all(t.startswith("one text") for t in main_texts([copies.format(i) for i in range(6)]))


@pytest.mark.parametrize("count", [1, 4, 6, 60])
def test_an_articles_own_heading_stays_however_many_pages(count):
    page = "<body><div class='x1'>Shop Home</div><article><h1>Title {0}</h1><h2>Summary</h2><p>text {0}</p></article></body>"
    got = main_texts([page.format(i) for i in range(count)])
    assert got == [f"Title {i}\n\nSummary\n\ntext {i}" for i in range(count)]


def test_unnamed_boxes_are_told_apart_without_word_lists(monkeypatch):
    """Neither tags nor words name the article: slots and template do."""
    import tidemark.llm.wrappers as module

    page = (
        "<body><div class='c1'>Home page {0} of 90</div><div class='c2'><div><span>Our shop</span><div>Open daily</div></div>"
        "<h1>Title {0}</h1><div class='t'>{1}</div><p>last {0}</p></div><div class='c3'>Posted by user{0}, 3 likes</div></body>"
    )
    pages = [page.format(i, f"long text number {i} " * 20) for i in range(8)]
    expected = [f"Title {i}\n\n{(f'long text number {i} ' * 20).strip()}\n\nlast {i}" for i in range(8)]
    for name in ("_aside_tags", "_aside_words", "_main_tags", "_main_words"):
        monkeypatch.setattr(module, name, set())
    assert module.main_texts(pages) == expected
    # Without the wrapper the template stays in.
    monkeypatch.setattr(module.Wrapper, "matches", lambda self, page: False)
    assert all("Open daily" in text for text in module.main_texts(pages))


def test_odd_pages(spark):
    rows = [(1, "http://a.b/x", None, 1), (2, None, "", 1), (None, "http://a.b/y", "plain < text", 1)]
    rows += [(3, "http://a.b/z", "<article><p>cut &amp; of", 1), (3, "http://a.b/z", "<article><p>cut &amp; of", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host int")
    got = sorted(((r.page_id, r.text, r.n_chars) for r in extract_main_text(pages).collect()), key=repr)
    assert got == [(1, "", 0), (2, "", 0), (3, "cut & of", 8), (3, "cut & of", 8), (None, "plain < text", 12)]
    assert extract_main_text(pages.limit(0)).collect() == []


def test_sentencepiece_parity(spark, sample, odd_docs, no_docs):
    reference = SentencePieceProcessor(model_file=model_path())
    texts = [r.text for r in sample.collect()] + ["", " ", "  a  b ", "<s> x", "\U0001f600\n\t", "▁▁b▁", "a "]
    for text, (ids, same) in zip(texts, tokenizer_of(model_path()).encode(texts), strict=True):
        assert same and np.frombuffer(ids, "<u4").tolist() == reference.encode(text)
    rows = encode_documents(odd_docs, model_path()).collect()
    assert len(rows) == odd_docs.count() and all(r.parity and r.round_trip for r in rows)
    assert encode_documents(no_docs, model_path()).collect() == []


def test_pipeline_runs_on_whole_tables(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and max(r.offset + r.length for r in rows) <= 2048


def test_pipeline_matches_plain_stages(spark, tmp_path, monkeypatch):
    """Every stage against plain Python, with short clean texts among the documents."""
    source = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{source}/documents.parquet")
    short = ["a", "of it", "the end", "12 34 !", "", None]
    more = spark.createDataFrame([(10**6 + i, t, len(t or "")) for i, t in enumerate(short)], "doc_id long, text string, n_chars long")
    more = more.withColumn("lang", F.lit(None).cast("string"))
    docs = docs.unionByName(more, allowMissingColumns=True)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{source}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    models = []
    learn = corpus_pipeline.learn_quality
    monkeypatch.setattr(corpus_pipeline, "learn_quality", lambda known: models.append(learn(known)) or models[-1])

    placed = corpus_pipeline.run(spark, str(tmp_path)).collect()

    rows = [r for r in docs.select("doc_id", "text", "n_chars").collect() if any(map(str.isalpha, r.text or ""))]
    assert {10**6, 10**6 + 1, 10**6 + 2} == {r.doc_id for r in rows if r.doc_id >= 10**6}
    found = corpus_pipeline.identify_language(spark, docs, str(tmp_path))
    assert sorted(r.doc_id for r in found.collect()) == sorted(r.doc_id for r in rows)
    rows = [r for r in rows if models[0].score(*features(r.text, float(r.n_chars))) >= THRESHOLD]
    last = {t: max(r.doc_id for r in rows if r.text == t) for t in {r.text for r in rows}}
    rows = [r for r in rows if r.doc_id == last[r.text]]
    kept = {i for i, _, _, stays in brute(rows) if stays}
    tokenizer = Tokenizer.from_file(tokenizer_path())
    expected = {r.doc_id: len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in rows if r.doc_id in kept}
    lengths: dict = {}
    for r in placed:
        lengths[r.doc_id] = lengths.get(r.doc_id, 0) + r.length
    assert lengths == expected


def _field(number, kind, data):
    head = bytes([number << 3 | kind]) if number < 16 else bytes([(number << 3 | kind) & 127 | 128, number >> 4])
    if kind == 2:
        size, out = len(data), b""
        while size > 127:
            out, size = out + bytes([size & 127 | 128]), size >> 7
        return head + out + bytes([size]) + data
    return head + data


def unigram_model(path, byte_fallback, symbols=()):
    """A model file written by hand: pieces with scores, nothing learnt."""
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    if byte_fallback:
        pieces += [(f"<0x{b:02X}>", -9.0, 6) for b in range(256)]
    pieces += [(s, 0.0, 4) for s in symbols]
    words = ["▁", "▁the", "▁a", "e", "t", "h", "a", "b", "ab", "▁ab", "$", "$$", "▁$", "▁$$", "s", "es", ".", "the"]
    pieces += [(w, -1.0 - i % 5, 1) for i, w in enumerate(words)]
    data = b""
    for piece, score, kind in pieces:
        body = _field(1, 2, piece.encode()) + _field(2, 5, struct.pack("<f", score)) + _field(3, 0, bytes([kind]))
        data += _field(1, 2, body)
    trainer = _field(3, 0, b"\x01") + (_field(35, 0, b"\x01") if byte_fallback else b"") + _field(40, 0, b"\x00")
    normalizer = _field(1, 2, b"identity") + _field(3, 0, b"\x01") + _field(4, 0, b"\x00") + _field(5, 0, b"\x01")
    path.write_bytes(data + _field(2, 2, trainer) + _field(3, 2, normalizer))
    return str(path)


@pytest.mark.parametrize("byte_fallback,symbols", [(False, ()), (True, ()), (True, ("<sep>",))])
def test_parity_of_unigram_models_is_that_of_whole_texts(spark, tmp_path, byte_fallback, symbols):
    path = unigram_model(tmp_path / "m.model", byte_fallback, symbols)
    reference = SentencePieceProcessor(model_file=path)
    rng = random.Random(8)
    parts = ["the", "ab", "$$$", "$", " ", " ", "  ", "é", "es.", "tab", "<sep>", "▁b", "z"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(150)]
    tokenizer = PieceTokenizer(path)
    assert not tokenizer.separable
    agree = 0
    for text, (ids, same) in zip(texts, tokenizer.encode(texts), strict=True):
        equal = np.frombuffer(ids, "<u4").tolist() == reference.encode(text)
        assert same == equal
        agree += equal
    assert agree > 0.6 * len(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = encode_documents(docs, path).collect()
    assert sum(r.parity for r in rows) == agree
