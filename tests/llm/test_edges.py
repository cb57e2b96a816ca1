"""Every operator and stage on nulls, empty and long texts, ties, repeats, empty tables, odd columns."""

import public_tokenizers
import pytest

import corpus_pipeline
from talentgrid.llm import byte_bpe, chat, chunks, langid, licenses, packing, quality, simhash, urls, warc
from talentgrid.llm.frames import new_folder

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
WORDS = public_tokenizers.path("word_bpe_49k.json")
TEXT = "The quick brown fox jumps over the lazy dog near the river bank. " * 3
ROWS = [
    (1, TEXT, "en", "a", 1), (2, None, None, None, None), (3, "", "en", "a", 0), (4, TEXT, "en", "a", 1),
    (4, TEXT, "en", "a", 1), (None, "Der Hund schläft heute.", "de", "b", 2), (5, " \n\t ", "de", "b", 3),
    (6, "müde " * 60_000, "de", None, 4), (7, "x" * 50_000, "en", "c", 5), (None, None, None, None, None),
]
#: Names that operators use for their results or inside, and one that differs in case only.
EXTRA = "score kept ids fp key words row prefix place TEXT c0".split()


def documents(spark, rows=ROWS):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    frame = spark.createDataFrame([(*row, *["?"] * len(EXTRA)) for row in rows], schema + "".join(
        f", {name} string" for name in EXTRA
    ))
    return frame


def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 1, 0), (None, 1, None), (3, 0, None)], "doc_id long, quality int, toxic int")


def trained(docs):
    return langid.predict(docs, langid.train(docs))


OPERATORS = {
    "licenses": lambda spark, docs: licenses.scan(docs),
    "encode": lambda spark, docs: byte_bpe.decode(byte_bpe.encode(docs, *RANKS), *RANKS),
    "quality": lambda spark, docs: quality.verdicts(docs, labels(spark)),
    "simhash": lambda spark, docs: simhash.near_duplicates(docs),
    "langid": lambda spark, docs: trained(docs),
    "fingerprints": lambda spark, docs: chunks.fingerprints(docs),
    "compared": lambda spark, docs: chunks.compared(docs, 3),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_for_each_document(spark, name):
    found = OPERATORS[name](spark, documents(spark))
    ids = [row.doc_id for row in found.collect()]
    assert sorted(ids, key=str) == sorted([row[0] for row in ROWS], key=str)


@pytest.mark.parametrize("name", [*OPERATORS, "pack"])
def test_empty_table(spark, name):
    run = OPERATORS.get(name, lambda spark, docs: packing.pack(docs, WORDS))
    assert run(spark, documents(spark, [])).collect() == []


def test_null_and_empty_texts_have_equal_results(spark):
    for name, run in OPERATORS.items():
        if name == "compared":
            continue
        rows = {(r.doc_id): r.asDict() for r in run(spark, documents(spark)).collect()}
        left, right = rows[2], rows[3]
        for row in (left, right):
            row.pop("doc_id")
            row.pop("held_out", None)
        assert left == right, name


def test_packing_of_odd_texts(spark):
    rows = packing.pack(documents(spark), WORDS).collect()
    assert sum(row.length for row in rows if row.doc_id == 2) == 1
    assert sum(row.length for row in rows if row.doc_id == 4) == 2 * next(r.doc_tokens for r in rows if r.doc_id == 4)
    assert all(row.offset + row.length <= 2048 for row in rows)


def test_simhash_of_odd_rows(spark):
    rows = simhash.near_duplicates(documents(spark)).collect()
    by_id = {}
    for row in rows:
        by_id.setdefault(row.doc_id, set()).add((row.fingerprint, row.component_id))
    assert by_id[4] == by_id[1] and {c for _, c in by_id[4]} == {1}
    assert by_id[2] == by_id[3] == by_id[5] == {("0" * 16, 2)}
    assert ("0" * 16, 2) in by_id[None]


def test_pages_with_nulls(spark):
    schema = "page_id long, url string, html string, host string, verdict string, digest string, payload string"
    body = "<p>" + "text " * 40
    rows = [(1, None, None), (2, "http://a.org/x", body), (2, "http://a.org/x", body), (3, "no scheme", body),
            (None, "HTTP://B.Org", body), (4, "http://c.com", "short"), (5, "http://d.com/\r\nX: y%0A", "short")]
    pages = spark.createDataFrame([(*row, "?", "?", "?", "?") for row in rows], schema)
    rules = spark.createDataFrame([("org", "/", "block"), (None, "/", "block"), ("org", "/", "allow")], "host string, path string, verdict string")
    found = sorted(urls.verdicts(pages, rules).collect(), key=str)
    assert len(found) == len(rows)
    assert {(r.page_id, r.rule, r.verdict) for r in found if r.rule} == {(2, "org/", "block")}
    assert {(r.host, r.path) for r in found if r.page_id in (1, 3)} == {("", "")}
    assert urls.verdicts(pages.limit(0), rules).collect() == []
    assert {r.verdict for r in urls.verdicts(pages, rules.limit(0)).collect()} == {"allow"}
    path = new_folder(spark, "warc")
    warc.write(pages, path)
    back = warc.read(spark, path).collect()
    assert sorted(((r.page_id, r.url) for r in back), key=str) == sorted((row[:2] for row in rows), key=str)
    assert {(r.page_id, r.record_type, r.refers_to) for r in back} == {
        (1, "response", None), (2, "response", None), (3, "revisit", 2), (None, "revisit", 2),
        (4, "response", None), (5, "response", None),
    }
    empty = new_folder(spark, "warc")
    warc.write(pages.limit(0), empty)
    assert warc.read(spark, empty).collect() == []


def test_transcripts_with_nulls(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 1, "assistant", None), (None, 0, None, "x"),
            (2, 0, "user", ""), (2, None, "user", "y"), (3, 0, "other", "z\n\nz")]
    talk = spark.createDataFrame([(*row, "?", "?") for row in rows], "conv_id long, turn long, role string, text string, part string, line string")
    lines = chat.transcripts(talk)
    found = chat.parse(lines, chat.train(lines), 3).collect()
    assert {row.conv_id for row in found} == {1, 2, 3, None}
    none = chat.transcripts(talk.limit(0))
    assert chat.parse(none, chat.train(none)).collect() == []


def test_stages_keep_columns(spark, tmp_path):
    folder = str(tmp_path)
    labels(spark).write.parquet(f"{folder}/labels.parquet")
    docs = documents(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, folder)
        assert kept.dtypes == docs.dtypes
        again = stage(spark, docs.limit(0), folder)
        assert again.columns == docs.columns and again.collect() == []
    kept = [row.doc_id for row in simhash.one_of_each(docs).collect()]
    assert sorted(map(str, kept)) == sorted(map(str, [1, 2, None, 6, 7]))
