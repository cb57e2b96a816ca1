"""Archives as they are found, left-out languages, rows of one id, blocks of one value, and the whole pipeline."""

import base64
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from talentgrid.llm import chunks, langid, packing, quality, simhash, warc
from talentgrid.llm.frames import checkpointed, new_folder, table
from tests.llm.test_edges import documents, labels
from tests.llm.test_methods import closure, statistics

LANGUAGES = ["de", "en", "es", "fr"]


# -- archives ---------------------------------------------------------------


def member(head, body, level=6):
    lines = "".join(f"{name}: {value}\r\n" for name, value in head)
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    data = b"WARC/1.0\r\n" + lines.encode() + f"content-length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"
    return packer.compress(data) + packer.flush()


def foreign(number, payload, digest=None, level=6):
    head = [("WARC-Type", "response"), ("warc-record-id", f"<urn:uuid:{number}>"), ("WARC-Target-URI", f"<http://x.org/{number}>")]
    if digest:
        head.append(("WARC-Payload-Digest", digest))
    return member(head, b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n" + payload, level)


def sha1(payload):
    return "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()


def archive():
    """(members, payloads by record id): responses of others, some with the magic inside, and other kinds of records."""
    chance, members, payloads = random.Random(6), [], {}
    members.append(member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<urn:uuid:info>")], b"software: x"))
    for number in range(60):
        payload = b"".join(warc.MAGIC + chance.randbytes(chance.choice([3, 300, 5000])) for _ in range(4))
        digest = [None, sha1(payload), "sha1:" + "A" * 32, "md5:" + hashlib.md5(payload).hexdigest(), "blake3:00"][number % 5]
        members.append(foreign(number, payload, digest, chance.choice([0, 6])))
        payloads[f"<urn:uuid:{number}>"] = (payload, [None, True, False, True, None][number % 5])
    revisit = [("WARC-Type", "revisit"), ("WARC-Record-ID", "<urn:uuid:again>"), ("WARC-Refers-To", "<urn:uuid:3>")]
    members.append(member(revisit, b"HTTP/1.1 304 Not Modified\r\n\r\n"))
    return members, payloads


@pytest.mark.parametrize("name", ["a.warc", "a.warc.gz"])
@pytest.mark.parametrize("size", [2000, 50_000, 1 << 27])
def test_archives_of_others(spark, tmp_path, monkeypatch, name, size):
    members, payloads = archive()
    (tmp_path / name).write_bytes(b"".join(members))
    monkeypatch.setattr(warc, "RANGE", size)
    monkeypatch.setattr(warc, "READ", 700)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        rows = warc.read(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    found = {r.record_id: (bytes(r.payload), r.verified) for r in rows if r.record_type == "response"}
    assert found == payloads and len(rows) == len(payloads) + 1
    assert {r.url for r in rows if r.url} == {f"http://x.org/{n}" for n in range(60)}
    assert all(r.payload_digest == hashlib.sha256(r.payload).hexdigest() and r.page_id is None for r in rows if r.payload)
    (again,) = [r for r in rows if r.record_type == "revisit"]
    assert (again.record_id, again.refers_to_id, again.refers_to, again.payload_bytes, again.payload_digest) == (
        "<urn:uuid:again>", "<urn:uuid:3>", None, None, None,
    )


def test_own_archives_under_the_usual_name(spark, sf_dir, tmp_path):
    path = new_folder(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    own = {tuple(r) for r in warc.read(spark, path).collect()}
    for number, part in enumerate(spark.read.format("binaryFile").load(path).select("content").collect()):
        (tmp_path / f"b{number}.warc.gz").write_bytes(part.content)
    assert {tuple(r) for r in warc.read(spark, str(tmp_path)).collect()} == own and len(own) > 40


def test_files_of_other_members_are_not_put_together(spark, tmp_path, monkeypatch):
    """Members that are no records: nothing is handed over, so nothing is gathered by file."""
    chance = random.Random(7)
    junk = [zlib.compress(chance.randbytes(200), 6, 31) for _ in range(3000)]
    (tmp_path / "junk.warc").write_bytes(b"".join(junk))
    (tmp_path / "good.warc").write_bytes(b"".join(archive()[0]))
    handed = []
    keep = warc.checkpointed
    monkeypatch.setattr(warc, "checkpointed", lambda frame: handed.append(keep(frame)) or handed[-1])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = warc.read(spark, str(tmp_path))
        assert rows.count() == 61
        grouped = handed[0].join(handed[0].filter("opens").select("path").distinct(), "path", "left_semi")
        assert {name.rsplit("/", 1)[1] for (name,) in grouped.select("path").distinct().collect()} == {"good.warc"}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_a_payload_of_many_megabytes(spark):
    body = "é" + "0123456789abcdef" * (1 << 20) + "".join(random.Random(8).choices("abcdefgh \n", k=1 << 20))
    pages = spark.createDataFrame([(1, "http://x.org/", body), (2, "http://y.org/" + "p" * 100_000, "short")], "page_id long, url string, html string")
    path = new_folder(spark, "warc")
    warc.write(pages, path)
    rows = {r.page_id: r for r in warc.read(spark, path).collect()}
    assert bytes(rows[1].payload) == body.encode() and rows[1].payload_bytes == len(body.encode()) > 1 << 24
    assert rows[2].url == "http://y.org/" + "p" * 100_000


# -- languages --------------------------------------------------------------


@pytest.mark.parametrize("out", [None, *LANGUAGES])
def test_texts_of_a_language_that_is_not_learned_go(spark, out):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    lang = F.when(F.col("lang") != F.lit(out), F.col("lang")) if out else F.col("lang")
    model = langid.train(docs.withColumn("lang", lang))
    assert model.languages == [name for name in LANGUAGES if name != out]
    kept = {r.doc_id for r in langid.accepted(docs, model).collect()}
    every = docs.collect()
    others = [r.doc_id in kept for r in every if r.lang != out]
    assert np.mean(others) >= 0.99
    if out:
        assert np.mean([r.doc_id in kept for r in every if r.lang == out]) <= 0.1


def test_strangeness_does_not_depend_on_the_number_of_languages(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    only = langid.train(docs.withColumn("lang", F.when(F.col("lang") == "en", "en")))
    kept = {r.doc_id for r in langid.accepted(docs, only).collect()}
    rows = docs.collect()
    assert only.languages == ["en"]
    assert np.mean([r.doc_id in kept for r in rows if r.lang == "en"]) >= 0.99
    assert np.mean([r.doc_id in kept for r in rows if r.lang != "en"]) <= 0.1


def test_every_label_is_learned(spark):
    rows = [(k, f"{word} " * 30, f"l{k % 60}") for k in range(300) for word in [f"{chr(97 + k % 26)}{chr(97 + k % 60 // 3)}q"]]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(model.languages) == 60


def test_features_and_one_step_by_hand():
    """Counts, TF-IDF values and one FTRL-proximal step, written out."""
    text = "Ab, b"
    clean, grams = " ab b", []
    for n in (1, 2, 3):
        grams += [clean[i:i + n] for i in range(len(clean) - n + 1)]

    def place(gram):
        value = 0
        for k, c in enumerate(gram):
            code = ord(c)
            if k == 0:
                value = code * 2654435761
            elif k == 1:
                value = (value ^ 0x5BD1E995) * 2246822519 + code * 2654435761
            else:
                value = (value ^ 0x27D4EB2F) * 3266489917 + code * 2654435761
            value %= 1 << 32
        return (value * 0x9E3779B1 % (1 << 32)) >> (32 - langid.BUCKET_BITS)

    counts = {}
    for gram in [g for g in grams if g != " " or True]:
        counts[place(gram)] = counts.get(place(gram), 0) + 1
    buckets, found = langid.gram_counts(text)
    got = dict(zip(buckets.tolist(), found.tolist()))
    lead = place(" ")
    assert got.keys() == counts.keys() and all(got[b] == n or b == lead for b, n in counts.items())
    model = langid.Model(["x", "y"], np.linspace(1, 2, langid.BUCKETS).astype(np.float32))
    raw = (1 + np.log(found)) * model.idf[buckets]
    assert model.values(buckets, found) == pytest.approx(raw / np.sqrt((raw ** 2).sum()))
    values = np.array([0.6, 0.8])
    weights, bias = langid.follow_the_leader([(np.array([3, 9]), values, 1)], 2, passes=1, rate=0.5, beta=1.0, lasso=0.02, ridge=0.02)
    for x, w in ((0.6, weights[3]), (0.8, weights[9])):
        for slope, got_weight in ((0.5 * x, w[0]), (-0.5 * x, w[1])):
            step = (1.0 + abs(slope)) / 0.5 + 0.02
            assert got_weight == pytest.approx(-(slope - np.sign(slope) * 0.02) / step)
    assert bias == pytest.approx([-0.5 / (1.5 / 0.5), 0.5 / (1.5 / 0.5)]) and not weights[0].any()


def test_equal_chances_go_to_the_first_language():
    model = langid.Model(["x", "y"], weights=np.zeros((langid.BUCKETS, 2), np.float32), bias=np.zeros(2, np.float32))
    assert model.predict("abc") == ("x", 0.5)


# -- rows of one id, blocks of one value --------------------------------------


def slow_compared(rows):
    """Fingerprints of rows in the operator's order, each with the next one's text."""
    out = []
    for (doc_id, text), (_, after) in zip(rows, [*rows[1:], rows[0]]):
        half = len(text) // 2
        new = text[:len(text) - half] + after[:half]
        own = chunks.chunks(text.encode())
        out.append((doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), chunks.written(own), chunks.containment(own, chunks.chunks(after.encode()))))
    return out


def slow_ends(raw):
    """Chunk ends byte by byte: a gear hash of the last 32 bytes, strict before NORMAL bytes, loose after."""
    hash_, mark = 0, []
    for byte in raw:
        hash_ = ((hash_ << 1) + int(chunks.GEAR[byte])) & 0xFFFFFFFF
        mark.append(hash_)
    found, start = [], 0
    while start < len(raw):
        end = None
        for place in range(start + chunks.LEAST, len(raw)):
            bits = chunks.STRICT if place - start < chunks.NORMAL else chunks.LOOSE
            if raw[place] & 0xC0 != 0x80 and mark[place - 1] < 1 << (32 - bits):
                end = place
                break
        end = end or len(raw)
        if end - start > chunks.MOST:
            end = start + chunks.MOST
            while raw[end] & 0xC0 == 0x80:
                end -= 1
        found.append(end)
        start = end
    return found


def test_chunk_ends_byte_by_byte():
    chance = random.Random(12)
    for size in [*range(40), 100, 1000, 20_000]:
        for alphabet in ("ab", "abcdefgh \n", "aé中🙂 "):
            raw = "".join(chance.choices(alphabet, k=size)).encode()
            assert chunks.ends(raw) == slow_ends(raw)


def test_rows_of_one_id_are_split(spark):
    """20,000 rows without an id and 10,000 copies under one id: no task gets more than a few shares."""
    rows = [(None, f"text number {k} " + "word " * (k % 7)) for k in range(20_000)] + [(5, "the same text")] * 10_000 + [(k, f"own {k}") for k in range(100, 3_000)]
    random.Random(3).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    dealt = chunks.neighbours(docs, 40)
    own = dealt.filter("guest = 0").groupBy("stretch").count().collect()
    assert sum(r["count"] for r in own) == len(rows)
    assert max(r["count"] for r in own) <= 3 * len(rows) / 40
    guests = dealt.filter("guest = 1").collect()
    assert len(guests) == len(own) and {g.stretch for g in guests} == {r.stretch for r in own}
    hashes = {r.text: r.h for r in docs.select("text", F.xxhash64("text").alias("h")).distinct().collect()}
    order = sorted(rows, key=lambda row: (row[0] is not None, row[0] or 0, hashes[row[1]]))
    found = chunks.compared(docs, 40).collect()
    got = sorted((str(r.doc_id), r.n_chars, r.edited_sha256, r.fingerprint, r.near_next) for r in found)
    assert got == sorted((str(a), b, c, d, e) for a, b, c, d, e in slow_compared(order))


@pytest.mark.parametrize("stretches", [1, 3, 50])
def test_few_rows_in_many_stretches(spark, stretches):
    rows = [(1, "a b c"), (1, "a b c"), (2, "d" * 500), (None, ""), (None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    hashes = {r.text: r.h for r in docs.select("text", F.xxhash64("text").alias("h")).distinct().collect()}
    order = sorted(rows, key=lambda row: (row[0] is not None, row[0] or 0, hashes[row[1]]))
    got = sorted((str(r.doc_id), r.n_chars, r.edited_sha256, r.fingerprint, r.near_next) for r in chunks.compared(docs, stretches).collect())
    assert got == sorted((str(a), b, c, d, e) for a, b, c, d, e in slow_compared(order))


def test_large_values_are_cut_whatever_their_share(spark, monkeypatch):
    """Blocks of a fixed size, for values above and below the share that is broadcast."""
    chance, prints = random.Random(3), set()
    for size in (300, 90, 90, 40):
        base = chance.getrandbits(64)
        for _ in range(size):
            value = base
            for _ in range(chance.randint(0, 5)):
                value ^= 1 << chance.randrange(64)
            prints.add(int(np.uint64(value).view(np.int64)))
    rows = list(enumerate(sorted(prints)))
    frame = checkpointed(spark.createDataFrame(rows, "doc_id long, fp long"))
    expected = closure([fp for _, fp in rows], [i for i, _ in rows])
    monkeypatch.setattr(simhash, "BLOCK_ROWS", 20)
    for share in (1, 8, 5000):
        monkeypatch.setattr(simhash, "HEAVY_SHARE", share)
        assert {r.fp: r.component_id for r in simhash.grouped(frame, 4).collect()} == expected


# -- quality ----------------------------------------------------------------


def test_score_and_verdict_of_documents_by_hand(spark, sf_dir):
    """The mean log ratio over a document's n-grams, from the ratios and hashes alone."""
    docs, marks = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    ratios = quality.log_ratios(docs, marks).first().ratios
    found = {r.doc_id: r for r in quality.verdicts(docs, marks).collect()}
    some = docs.orderBy("doc_id").limit(40).withColumn("one", F.expr("transform(filter(split(text, '[ \\t-\\r]+'), x -> x != ''), x -> xxhash64(x))"))
    some = some.withColumn("two", F.expr("transform(sequence(1, size(one) - 1), i -> xxhash64(one[i - 1], one[i]))"))
    for row in some.collect():
        grams = [*row.one, *row.two] if len(row.one) > 1 else row.one
        score = sum(ratios[g % quality.BUCKETS] for g in grams) / len(grams)
        words, *_, repeated = statistics(row.text)
        failed = words < 20 or 100 * repeated > 30 * words
        r = found[row.doc_id]
        assert r.score == pytest.approx(score, abs=1e-9)
        assert r.kept == (not failed and score >= quality.THRESHOLD)


def test_labels_outside_the_target_are_separated(spark):
    """Half of the labels make the target; the other half is judged."""
    docs, marks = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    learned = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    kept = {r.doc_id: r.kept for r in quality.verdicts(docs, marks.filter(learned)).collect()}
    judged = marks.filter(~learned).collect()
    good = [kept[r.doc_id] for r in judged if r.quality == 1 and not r.toxic]
    bad = [kept[r.doc_id] for r in judged if r.quality == 0]
    assert len(good) > 1000 and np.mean(good) >= 0.93
    assert len(bad) > 200 and np.mean(bad) <= 0.15


# -- the pipeline -------------------------------------------------------------


def test_pipeline_equals_its_stages_one_by_one(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    docs, marks = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = langid.train(docs)
    first = [r for r in docs.collect() if model.knows(r.text)]
    second_docs = spark.createDataFrame(first, docs.schema)
    verdicts = {r.doc_id: r.kept for r in quality.verdicts(second_docs, marks).collect()}
    second = [r for r in first if verdicts[r.doc_id]]
    prints = [int(np.uint64(simhash.fingerprint_of(r.text.encode()) & ((1 << 64) - 1)).view(np.int64)) for r in second]
    least = closure(prints, [r.doc_id for r in second], corpus_pipeline.MOST_BITS)
    third = {r.doc_id: r.text for r, fp in zip(second, prints) if least[fp] == r.doc_id}
    assert 0 < len(third) < len(second) < len(first) <= docs.count()
    words, found, fill = packing.words_of(corpus_pipeline.TOKENIZER, special=True), {}, {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        assert r.start * 4 == len(found.get(r.doc_id, b""))
        found[r.doc_id] = found.get(r.doc_id, b"") + bytes(r.ids)
        fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
    expected = {i: np.append(np.frombuffer(words.ids(text), "<u4"), 1).astype("<u4").tobytes() for i, text in third.items()}
    assert found == expected
    for parts in fill.values():
        parts.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:])) and parts[0][0] == 0
        assert sum(parts[-1]) <= corpus_pipeline.SEQUENCE_TOKENS


def test_last_stage_on_odd_rows(spark, tmp_path):
    labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    docs = documents(spark)
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert sorted({str(r.doc_id) for r in rows}) == sorted({str(r.doc_id) for r in docs.collect()})
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), str(tmp_path)).collect() == []


def test_the_sieve_lets_all_its_ids_through(spark, monkeypatch):
    ids, others = spark.range(0, 3000).select(F.col("id").alias("doc_id")), spark.range(10_000, 40_000).select(F.col("id").alias("doc_id"))
    for bits in (7, 12, quality.SIEVE_BITS):
        monkeypatch.setattr(quality, "SIEVE_BITS", bits)
        marks = quality.sieve(ids)
        passed = [rows.withColumn("m", marks.scalar()).filter(quality.sifted(F.col("doc_id"), F.col("m"))).count() for rows in (ids, others)]
        assert passed[0] == 3000 and passed[1] <= (30_000 if bits == 7 else 20_000 if bits == 12 else 50)
    empty = quality.sieve(ids.limit(0))
    assert ids.withColumn("m", empty.scalar()).filter(quality.sifted(F.col("doc_id"), F.col("m"))).count() == 0


def test_target_with_one_id_on_a_third_of_the_rows(spark):
    rows = [(7, f"a{k} b")  for k in range(3000)] + [(None, "n o")] * 3000 + [(100 + k, f"c{k}") for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(7, 1, 0), (7, 1, 0), (100, 1, 0), (101, 0, 0), (102, 1, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    ratios = quality.log_ratios(docs, marks).first().ratios
    hashes = spark.createDataFrame([("b",), ("n",), ("c0",), ("c1",), ("c2",)], "w string").withColumn("h", F.expr("xxhash64(w)")).collect()
    place = {r.w: r.h % quality.BUCKETS for r in hashes}
    assert ratios[place["b"]] > 0.3 > 0 > ratios[place["n"]] and ratios[place["c0"]] > ratios[place["c1"]] == pytest.approx(ratios[place["c2"]], abs=0.2)


def test_every_labelled_text_is_learned_from(spark):
    """Texts of one character each, half of them a's: only who has seen a text can tell its label."""
    rows = [(i, chr(0x4E00 + i) * 3, "ab"[zlib.crc32(b"%d" % i) >> 5 & 1]) for i in range(16_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    truth = {i: lang for i, _, lang in rows}
    found = langid.predict(docs, langid.train(docs)).filter("NOT held_out").collect()
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in found]) >= 0.8


def test_shards_do_not_depend_on_partitions(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rare = docs.withColumn("lang", F.when(F.col("lang").isin("en", "de") | (F.col("doc_id") % 8 == 0), F.col("lang")))
    one, other = (langid.train(rows, shard_grams=30_000) for rows in (rare, rare.repartition(7)))
    for name in ("idf", "weights", "bias", "familiar", "temperature", "most_strange"):
        assert np.array_equal(getattr(one, name), getattr(other, name))
    right = {r.doc_id: r.lang for r in docs.collect()}
    held = [r for r in langid.predict(docs, one).collect() if r.held_out]
    assert np.mean([r.lang_pred == right[r.doc_id] for r in held]) >= 0.95
