"""Alignment, classifier and run operators against brute force and held-out accuracy."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from talentgrid.llm import align, convnet, periodic
from talentgrid.llm.frames import table
from talentgrid.llm.queries import QUERIES
from tests.llm.test_edges import ROWS, documents, labels

FILES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# -- alignment --------------------------------------------------------------


def slow_tokens(texts):
    """(ids, bytes of the tokens) of each text by both tokenizers; None where they don't spell it."""
    a_tool, b_tool = Tokenizer.from_file(FILES[0]), sentencepiece.SentencePieceProcessor(model_file=FILES[1])
    a_tool.encode_special_tokens = True
    visible = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace() and b not in range(0x7F, 0xA1) and b != 0xAD]
    letters = {chr(b): b for b in visible}
    letters |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in visible)}
    for text in texts:
        if not text:
            yield None
            continue
        a_ids = a_tool.encode(" " + text, add_special_tokens=False).ids
        a = [bytes(letters[c] for c in a_tool.id_to_token(i)) for i in a_ids]
        b_ids = b_tool.encode(text)
        b = []
        for piece in map(b_tool.id_to_piece, b_ids):
            byte = re.fullmatch("<0x([0-9A-F]{2})>", piece)
            b.append(bytes.fromhex(byte[1]) if byte else piece.replace("▁", " ").encode())
        whole = (" " + text).encode()
        yield (a_ids, a, b_ids, b) if b"".join(a) == whole == b"".join(b) else None


def slow_alignment(texts):
    """The contract's numbers for each text, by comparing all pairs of byte ranges around a byte."""
    documents = []
    for tokens in slow_tokens(texts):
        if tokens is None:
            documents.append((0, 0, "", []))
            continue
        a_ids, a, b_ids, b = tokens
        a_of, b_of = ([k for k, token in enumerate(side) for _ in token] for side in (a, b))
        links = sorted(set(zip(a_of, b_of)))
        a_ends, b_ends = (set(np.cumsum([len(t) for t in side]).tolist()) for side in (a, b))
        ends = sorted(a_ends & b_ends)
        groups = []
        for low, high in zip([0, *ends], ends):
            groups.append("|".join(",".join(str(ids[k]) for k in sorted(set(of[low:high]))) for ids, of in ((a_ids, a_of), (b_ids, b_of))))
        documents.append((len(a_ids), len(b_ids), ";".join(groups), [(a_ids[i], b_ids[j]) for i, j in links]))
    counts, best = Counter(), defaultdict(int)
    for *_, links in documents:
        counts.update(set(links))
    for (a_id, _), n in counts.items():
        best[a_id] = max(best[a_id], n)
    return [
        (n_a, n_b, groups.count(";") + 1 if groups else 0, len(links), sum(counts[x] == best[x[0]] for x in links),
         sum(counts[x] for x in links), hashlib.sha256(groups.encode()).hexdigest() if groups else "", groups)
        for n_a, n_b, groups, links in documents
    ]


ODD = [
    None, "", " ", "  two  spaces ", "a <|endoftext|> b<s></s><unk>", "<0x41> ▁ x", "x\0y\n\n\tz", "中文没有空格的句子。",
    "é́ ﬁ Ａ １２", "naïve café's we'll", "x" * 3000, "  　 \xa0", "🙂🙃 👩‍👩‍👧", "the the the", "the",
]
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment_equals_brute_force(spark, sf_dir):
    texts = ODD + [r.text for r in table(spark, sf_dir, "documents").collect()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = slow_alignment(texts)
    found = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in align.scored(docs, *FILES).collect()}
    assert [found[i] for i in range(len(texts))] == [row[:7] for row in expected]
    spelled = {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.groups) for r in align.align(docs, *FILES).collect()}
    assert [spelled[i] for i in range(len(texts))] == [(*row[:4], row[7]) for row in expected]


def test_alignment_query_and_repeated_rows(spark, sf_dir):
    rows = QUERIES["op11_alignment"](spark, sf_dir)
    assert rows.columns == ["doc_id", *COLUMNS] and rows.count() == table(spark, sf_dir, "documents").count()
    docs = documents(spark)
    found = sorted((str(r.doc_id), r.n_links, r.count_sum) for r in align.scored(docs, *FILES).collect())
    assert [i for i, _, _ in found] == sorted(str(row[0]) for row in ROWS)
    expected = slow_alignment([row[1] for row in ROWS])
    assert [(n, s) for i, n, s in found if i == "4"] == [(expected[3][3], expected[3][5])] * 2
    assert align.scored(docs.limit(0), *FILES).collect() == [] == align.align(docs.limit(0), *FILES).collect()


@pytest.mark.parametrize("narrow,packs", [(4, True), (1, True), (4, False)])
def test_windows_are_remembered_and_forgotten(spark, sf_dir, monkeypatch, narrow, packs):
    monkeypatch.setattr(align, "NARROW", narrow)
    tool = align.Aligner(*FILES)
    tool.packs = packs
    texts = [*ODD, *[f"word{k} and more{k} and word{k}" for k in range(50)], *[r.text for r in table(spark, sf_dir, "documents").limit(40).collect()]] * 2
    expected = slow_alignment(texts)

    def same(parts):
        rows = []
        for part in parts:
            found = tool.block(part)
            ends = np.cumsum(found.n_links)
            for k, n in enumerate(found.n_links):
                links = found.pairs[found.links[ends[k] - n:ends[k]]]
                rows.append((found.n_a[k], found.n_b[k], align.n_groups(found.groups[k]), n, found.groups[k], Counter(links.tolist())))
        assert [row[:5] for row in rows] == [(*row[:4], row[7]) for row in expected]
        counts = Counter()
        for row in rows:
            counts.update(row[5].keys())
        assert [sum(counts[p] * n for p, n in row[5].items()) for row in rows] == [row[5] for row in expected]

    same([texts])
    assert 50 < len(tool.windows) < sum(row[2] for row in expected)
    all_windows = len(tool.windows)
    monkeypatch.setattr(align, "REMEMBERED", 300)  # what is remembered goes before a block's new windows come
    same([texts[k:k + 7] for k in range(0, len(texts), 7)])
    assert len(tool.windows) < all_windows


def test_the_fast_encoder_gives_the_ids_of_the_file():
    """Every character in several places, strings of tokens, and long runs."""
    tool, chance = align.Aligner(*FILES), random.Random(21)
    codes = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{chr(c)}1 {chr(c)}{chr(c)}. {chr(c)}b" for c in codes[k:k + 500]) for k in range(0, len(codes), 500)]
    pieces = [token.decode("utf-8", "ignore") for token in tool.a.tokens] + [" ", "  ", "\n", " \t\n ", "'ll", "<|endoftext|>", "\u3000", "é́"]
    texts += ["".join(chance.choices(pieces, k=chance.randint(1, 30))) for _ in range(20_000)]
    texts += ["".join(chance.choices("etaoin shr", k=chance.randint(1, 200))) for _ in range(5_000)]
    texts += ["x" * 300_000, "a" + " " * 19_999 + "b", "a" + " " * 25_000, " \n" * 400_000 + "end", "!" * 100_000]
    assert tool.a_ranked is not None
    for at in range(0, len(texts), 500):
        part = texts[at:at + 500]
        expected = [found.ids for found in tool.a_encoder.encode_batch_fast(part, add_special_tokens=False)]
        assert list(map(tool.a_ids, part)) == expected


def test_blocks_hold_so_many_characters(monkeypatch):
    rows = pa.RecordBatch.from_arrays([pa.array(range(9)), pa.array(["a" * 10] * 4 + ["b" * 100, None, "", "c", "d" * 22])], names=["i", "t"])
    monkeypatch.setattr(align, "BLOCK_CHARS", 25)
    assert [ids for ids, _ in align.gathered([rows])] == [[0, 1], [2, 3], [4], [5, 6, 7], [8]]
    assert [i for ids, _ in align.gathered([rows.slice(0, 2), rows.slice(2)]) for i in ids] == list(range(9))


# -- classifier -------------------------------------------------------------


def test_slopes_equal_differences():
    chance = np.random.default_rng(3)
    network = convnet.Network.fresh(5)
    network = convnet.Network(*[w.astype(float) for w in network.weights])
    codes = chance.integers(0, 256, (5, convnet.PIECE)).astype(np.uint8)
    sizes, owner, marks = np.array([512, 40, 512, 0, 512]), np.array([0, 0, 1, 2, 2]), np.array([1, 0, 1])
    for k, size in enumerate(sizes):
        codes[k, size + 8 if size == 512 else size:] = 0
    _, slopes = network.slopes(codes, sizes, owner, marks)
    for weight, slope in zip(network.weights, slopes):
        flat, found = weight.reshape(-1), slope.reshape(-1)
        for at in chance.choice(len(flat), min(12, len(flat)), replace=False):
            old, step = flat[at], 1e-6
            flat[at] = old + step
            above, _ = network.slopes(codes, sizes, owner, marks)
            flat[at] = old - step
            below, _ = network.slopes(codes, sizes, owner, marks)
            flat[at] = old
            assert found[at] == pytest.approx((above - below) / (2 * step), abs=1e-6)


def slow_score(network, text):
    """The network's definition, place by place."""
    places = -(-len(text) // convnet.STEP)
    raw = text + bytes(convnet.WIDTH)
    answers = []
    for p in range(places):
        seen = network.embedding[list(raw[p * convnet.STEP:p * convnet.STEP + convnet.WIDTH])]
        parts = seen.reshape(convnet.BLOCKS, -1)
        answers.append(sum(parts[k] @ network.filters[k] for k in range(convnet.BLOCKS)) + network.bias)
    half = convnet.HALF // convnet.STEP
    halves = -(-places // half)
    chunks = [answers[h * half:(h + 2) * half] for h in range(max(halves - 1, 1))]
    pooled = [np.maximum(np.max(part, 0), 0) if part else np.zeros(convnet.FILTERS) for part in chunks]
    hidden = np.mean([np.tanh(p @ network.hidden + network.hidden_bias) for p in pooled], 0)
    return 1 / (1 + np.exp(-(hidden @ network.out + network.out_bias[0])))


def test_scores_equal_the_definition(monkeypatch):
    chance, network = random.Random(8), convnet.Network.fresh(2)
    sizes = [0, 1, 3, 4, 5, 255, 256, 257, 511, 512, 513, 700, 1024, 5000, 0, 2]
    texts = [chance.randbytes(n) for n in sizes]
    expected = [slow_score(network, text) for text in texts]
    assert network.scores(texts) == pytest.approx(expected, abs=1e-5)
    monkeypatch.setattr(convnet, "AT_ONCE", 512)  # long texts in parts
    assert network.scores(texts) == pytest.approx(expected, abs=1e-5)


def test_every_byte_counts():
    network = convnet.Network.fresh(2)
    network.embedding[1] *= 50
    text = b"a" * 300_000
    plain = network.scores([text])[0]
    for at in (0, 99_999, 299_999):
        assert network.scores([text[:at] + b"\1" + text[at + 1:]])[0] != plain


def test_training_chunks_cover_short_texts():
    for size in (0, 1, 500, 512, 513, 1100, 2000):
        text = bytes(range(256)) * 8
        parts = convnet.spread_chunks(text[:size])
        assert parts[0] == text[:size][:convnet.PIECE] and parts[-1] == text[:size][(len(parts) - 1) * convnet.HALF:][:convnet.PIECE]
        assert (len(parts) - 1) * convnet.HALF + convnet.CHUNK >= size
    assert len(convnet.spread_chunks(bytes(10**6))) == convnet.PIECES


def test_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    marks = {r.doc_id: r for r in table(spark, folder, "labels").collect()}
    rows = QUERIES["op12_quality_classifier"](spark, folder).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in marks]
    good = [r.predicted for r in held if marks[r.doc_id].quality == 1]
    bad = [r.predicted for r in held if marks[r.doc_id].quality == 0]
    assert np.mean(good) >= 0.98 and np.mean(bad) <= 0.2


def test_classifier_on_odd_rows(spark):
    docs = documents(spark)
    for network in (None, convnet.train(docs, labels(spark))):
        rows = convnet.score(docs, network).collect()
        assert sorted((r.doc_id for r in rows), key=str) == sorted((row[0] for row in ROWS), key=str)
        assert len({r.score for r in rows if r.doc_id in (2, 3)}) == 1
    assert convnet.train(docs, labels(spark).limit(0)) is None is convnet.train(docs.limit(0), labels(spark))
    assert convnet.score(docs.limit(0), None).collect() == []


def test_labels_of_held_out_rows_teach_nothing(spark, sf_dir):
    docs, marks = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    turned = marks.withColumn("quality", (1 - marks.quality).cast("int")).filter(convnet.held_out(marks.doc_id))
    mixed = marks.filter(~convnet.held_out(marks.doc_id)).select("doc_id", "quality").union(turned.select("doc_id", "quality"))
    one, other = convnet.train(docs, marks), convnet.train(docs, mixed)
    assert all((a == b).all() for a, b in zip(one.weights, other.weights))


# -- runs -------------------------------------------------------------------


def slow_runs(words):
    """All runs that count, by the definition: every period, every maximal stretch."""
    found = []
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            start, length = i, j + q - i
            if length >= max(6, 4 * q) and not any(
                all(words[k] == words[k + d] for k in range(start, start + length - d)) for d in range(1, q)
            ):
                found.append((start, length, q))
            i = max(j, i) + 1
    return sorted(found, key=lambda run: (run[0], run[2]))


def some_words(chance):
    words = [b"%d" % chance.randrange(chance.choice([1, 2, 2, 3, 6])) for _ in range(chance.randint(0, 50))]
    for _ in range(chance.randint(0, 3)):
        if words:
            at, period = chance.randrange(len(words)), chance.randint(1, 6)
            root = words[at:at + period]
            words[at:at] = root * chance.randint(1, 9)
    return words


def test_runs_equal_brute_force():
    chance, hits = random.Random(9), 0
    for _ in range(700):
        words = some_words(chance)
        expected = slow_runs(words)
        hits += len(expected)
        assert periodic.runs_of_words(words) == expected
        if words:  # without parting the words first
            symbols = np.unique(words, return_inverse=True)[1] + 1
            assert sorted(periodic.runs_of_stretch(symbols), key=lambda run: (run[0], run[2])) == expected
    assert hits > 500


def test_common_beginnings_equal_brute_force():
    chance = random.Random(10)
    for n in (1, 2, 17, 200):
        symbols = [chance.randint(1, 2) for _ in range(n)]
        tree = periodic.SuffixTree([*symbols, 0], 3)
        tree.tour()
        pairs = [(i, j) for i in range(n) for j in range(n) if i != j]
        whole = [*symbols, 0]
        expected = [next(k for k in range(n + 1) if max(i, j) + k > n or whole[i + k] != whole[j + k]) for i, j in pairs]
        if pairs:
            assert tree.common(*map(np.array, zip(*pairs))).tolist() == expected
        ranks = tree.ranks()
        assert sorted(range(n + 1), key=ranks.__getitem__) == sorted(range(n + 1), key=lambda i: whole[i:])
        turned = [-s % 3 for s in whole]
        assert sorted(range(n + 1), key=tree.ranks(True).__getitem__) == sorted(range(n + 1), key=lambda i: turned[i:])


def test_runs_of_long_texts():
    assert periodic.runs_of_words([b"a"] * 60_000) == [(0, 60_000, 1)]
    words = [b"%d" % k for k in range(500)] + [b"%d" % (k % 777) for k in range(50_000)]
    assert (500, 50_000, 777) in periodic.runs_of_words(words)


def slow_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = slow_runs(words)
    dropped = {i for start, length, period in runs for i in range(start + period, start + length)}
    kept = " ".join(word for i, word in enumerate(words) if i not in dropped)
    longest = min(runs, key=lambda run: (-run[1], run[0], run[2]), default=None)
    lines = "".join(f"{start},{length},{period}\n" for start, length, period in runs)
    return (
        len(runs), *((*longest, 1000 * longest[1] // longest[2]) if longest else (None,) * 4),
        *[hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)],
    )


def test_run_query_equals_brute_force(spark, sf_dir):
    texts = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    short = {i: text for i, text in texts.items() if len(text or "") < 6000}
    found = {r.doc_id: tuple(r)[1:] for r in QUERIES["op13_periodic_runs"](spark, sf_dir).collect()}
    assert set(found) == set(texts) and len(short) > 100
    expected = {i: slow_row(i, text) for i, text in short.items()}
    assert {i: found[i] for i in short} == expected
    assert sum(row[0] > 0 for row in expected.values()) > 15


def test_runs_of_odd_rows(spark):
    planted = periodic.planted(documents(spark))
    assert planted.dtypes == documents(spark).dtypes
    rows = periodic.digests(periodic.find(planted)).collect()
    assert sorted((r.doc_id for r in rows), key=str) == sorted((row[0] for row in ROWS), key=str)
    empty = hashlib.sha256(b"").hexdigest()
    for r in rows:
        if r.doc_id in (2, 3, 5):
            assert tuple(r)[1:] == (0, None, None, None, None, empty, empty)
    assert [r.length for r in rows if r.doc_id == 6] == [60_000]
    odd = [(k, text) for k, text in enumerate(["a\x1cb " * 9, "a\xa0a " * 9, "\x0b\x0c a\ta a\na a a\r", "é é é é é é", None] * 40)]
    frame = spark.createDataFrame(odd, "doc_id long, text string")
    found = {r.doc_id: tuple(r)[1:] for r in periodic.digests(periodic.find(periodic.planted(frame))).collect()}
    assert found == {i: slow_row(i, text) for i, text in odd}
    assert periodic.find(frame.limit(0)).collect() == []


def test_spans_and_texts(spark):
    frame = spark.createDataFrame([(1, "x a b a b a b a b y")], "doc_id long, text string")
    row = periodic.find(frame).first()
    assert (row.n_words, [tuple(run) for run in row.runs], row.collapsed) == (10, [(1, 8, 2)], "x a b y")
