"""Every operator on nulls, empty and long texts, repeated rows, empty tables and clashing column names."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import chat, decontamination, html, language, neardup, packing, quality, scoring, tokens, toxicity

CLASH = "id bigint, n bigint, token string, k0 string, text_digest string, kept string, score string, failed string, length int, n_words string"
DOCS = f"doc_id bigint, text string, lang string, {CLASH}"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def rows(*pairs):
    return [(i, t, lang, 1, 2, "t", "k", "d", "no", "s", "f", 3, "w") for i, t, lang in pairs]


LONG = " ".join(f"w{i % 977}" for i in range(60_000))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(
        rows((1, None, "en"), (2, "", None), (3, " \n\t ", "en"), (4, "one two", "en"), (None, "one two three four five", None), (5, LONG, "en"),
             (6, LONG, "de"), (6, LONG, "de"), (7, "word " * 3000, "de"), (8, "x" * 50_000, "en"), (9, "été naïve 漢字 😀 <|endoftext|>", "fr"), (9, "another text", "fr")),
        DOCS,
    )


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (5, None, 1), (7, 0, None), (None, 1, 1), (4, 1, 1), (99, 1, 0)], "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, None), (2, ""), (None, "one two"), (3, " ".join(f"w{i}" for i in range(40))), (3, "two")], "item_id bigint, text string")


def toxicity_scores(docs, labels):
    sample = toxicity.training_sample(docs, labels, None, 100, "doc_id", "text")
    return toxicity.score_documents(docs, toxicity.learn_model(sample))


OPERATORS = {
    "scoring": lambda d, lab, b: scoring.cross_entropy_difference(d, lab.filter("quality = 1"), bits=12),
    "neardup": lambda d, lab, b: neardup.link_copies(d),
    "tokens": lambda d, lab, b: tokens.count_tokens(d, public_tokenizers.path("word_bpe_49k.json")),
    "toxicity": lambda d, lab, b: toxicity_scores(d, lab),
    "decontamination": lambda d, lab, b: decontamination.find_contamination(d, b),
    "decontamination in blocks": lambda d, lab, b: decontamination.find_contamination(d, b, block_chars=30),
    "quality": lambda d, lab, b: quality.apply_policy(quality.rule_ledger(d)),
    "language": lambda d, lab, b: language.learn_and_identify(d, F.lit(True)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_row_for_each_document(spark, docs, labels, benchmark, name):
    found = OPERATORS[name](docs, labels, benchmark)
    assert sorted(str(r["doc_id"]) for r in found.select("doc_id").collect()) == sorted(str(r["doc_id"]) for r in docs.select("doc_id").collect())
    assert len(set(found.columns)) == len(found.columns)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(spark, docs, labels, benchmark, name):
    assert OPERATORS[name](docs.limit(0), labels.limit(0), benchmark.limit(0)).count() == 0


@pytest.mark.parametrize("name", OPERATORS)
def test_documents_without_other_tables(spark, docs, labels, benchmark, name):
    assert OPERATORS[name](docs, labels.limit(0), benchmark.limit(0)).count() == docs.count()


def test_blocks_of_tests_change_nothing(spark, docs, benchmark):
    one, several = (sorted(map(str, decontamination.find_contamination(docs, benchmark, block_chars=n).collect())) for n in (10**6, 30))
    assert one == several
    assert sum("True" in r for r in one) > 0


def test_packing_keeps_every_token(spark, docs):
    found = packing.pack(docs, VOCABULARY).collect()
    assert {r["doc_id"] for r in found} == {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert packing.pack(docs.limit(0), VOCABULARY).count() == 0


@pytest.mark.parametrize("keep", [neardup.drop_copies, quality.keep_passing, decontamination.decontaminate])
def test_filters_keep_the_columns(spark, docs, benchmark, keep):
    found = keep(docs, benchmark) if keep is decontamination.decontaminate else keep(docs)
    assert found.columns == docs.columns
    assert [t for _, t in found.dtypes] == [t for _, t in docs.dtypes]
    found.collect()


def test_toxic_filter_keeps_the_columns(spark, docs, labels):
    model = toxicity.learn_model(toxicity.training_sample(docs, labels, None, 100, "doc_id", "text"))
    assert toxicity.drop_toxic(docs, model).columns == docs.columns


def test_near_duplicates_without_words_or_id(spark, docs):
    found = {}
    for r in neardup.link_copies(docs).collect():
        found.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"], r["kept"]))
    assert found[1] == [(0, 1, True)] and found[2] == [(0, 2, True)] and found[3] == [(0, 3, True)]
    assert found[None] == [(2, None, True)]
    assert [c for _, c, _ in found[6]] == [5, 5] and found[5][0][2]


def test_pages(spark):
    schema = "page_id bigint, url string, html string, text string, n_chars bigint, key bigint"
    pages = spark.createDataFrame(
        [(1, None, None, "t", 1, 1), (2, "u", "", "t", 1, 1), (None, "u", "<article><p>a &amp; b</p></article>", "t", 1, 1),
         (3, "u", "<p>open <b>never closed <div><<>> </article></p>" * 50, "t", 1, 1), (4, "u", "<div>" * 2000 + "deep", "t", 1, 1),
         (5, "u", "<article>" + "<p>long text here.</p>" * 5000 + "</article>", "t", 1, 1)],
        schema,
    )
    found = {r["page_id"]: r for r in html.extract(pages, html.learn_field(pages)).collect()}
    assert len(found) == 6 and found[1]["text"] == "" and found[2]["n_chars"] == 0
    assert found[None]["text"] == "a & b" and found[5]["text"].count("\n") == 4999
    assert html.extract(pages.limit(0), html.learn_field(pages.limit(0))).count() == 0


def test_chats(spark):
    schema = "conv_id bigint, turn bigint, role string, text string, message string, seq string, log string"
    given = spark.createDataFrame(
        [(1, 0, "user", None, "m", "s", "l"), (1, None, None, "<|end|>\\ [INST]", "m", "s", "l"), (1, 1, "assistant", "", "m", "s", "l"),
         (None, 0, "assistant", "a\\b", "m", "s", "l"), (2, 0, "assistant", "twice", "m", "s", "l"), (2, 0, "assistant", "twice", "m", "s", "l")],
        schema,
    )
    found = {r["conv_id"]: r for r in chat.digests(chat.format_chats(chat.events_of(given))).collect()}
    assert {k: r["n_turns"] for k, r in found.items()} == {1: 3, None: 1, 2: 2}
    assert {k: r["loss_chars"] for k, r in found.items()} == {1: 0, None: 3, 2: 10}
    assert chat.digests(chat.format_chats(chat.events_of(given.limit(0)))).count() == 0
