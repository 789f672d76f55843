"""Lexical search, sentence pieces and importance resampling against brute force and the library."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from agorascope.llm import importance, lexical, sentence_pieces

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
ODD = [None, "", " \t", "É é E e ÀB", "a-b_c d e 漢字 x²", "İ I ı i", "\x00a\x7fb~c[d]", "😀 😀 smile", "The the THE"]


def documents(rng, n):
    words = [f"w{i}" for i in range(40)] + ["Ünï", "The", "the", "x1"]
    rows = [(rng.choice([None, i, i]), t) for i, t in enumerate(ODD)]
    for i in range(n):
        rows.append((rng.choice((i, i, i, 7, None)), " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))))
    return rows + rows[:5] + [(500, "same text here"), (501, "same text here"), (499, "same text here")] * 2


def ranked(rows, items, k):
    """(item, rank, id, score) by definition."""
    texts = [re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOWER)) for _, t in rows]
    counts = [Counter(t) for t in texts]
    n_docs, length, df = sum(map(bool, texts)), sum(map(len, texts)), Counter(w for c in counts for w in c)
    out = Counter()
    for item, text in items:
        asked, scored = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER)), []
        for (i, _), c, words in zip(rows, counts, texts, strict=True):
            if words:
                m = 25 + (75 * len(words) * n_docs) // length
                score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in asked if t in c)
                if score > 0:
                    scored.append((-score, i is None, i or 0, i))
        for rank, (score, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1):
            out[item, rank, i, -score] += 1
    return out


def test_search_is_exact(spark):
    rng = random.Random(5)
    rows = documents(rng, 150)
    items = [(i, " ".join(rng.choice(rows)[1] or "" for _ in range(2))) for i in range(12)] + [(3, "same text"), (None, "same text"), (20, None), (21, "--"), (22, "nowhere")]
    given, asked = spark.createDataFrame(rows, "doc_id long, text string").repartition(5), spark.createDataFrame(items, "item_id long, text string")
    index = lexical.build(given)
    assert index.shards.count() == 5
    expected = ranked(rows, items, 10)
    for block_bytes in (lexical.BLOCK_BYTES, 200):
        assert Counter(map(tuple, lexical.search(index, asked, block_bytes=block_bytes).collect())) == expected


def test_an_index_is_found_again(spark, tmp_path):
    given = spark.createDataFrame([("b", "one two"), ("a", "one two"), ("c", "three")], "name string, body string")
    lexical.build(given, f"{tmp_path}/index", "name", "body")
    asked = spark.createDataFrame([(1, "Two")], "item_id int, text string")
    assert [(r.rank, r.name) for r in lexical.search(lexical.opened(spark, f"{tmp_path}/index"), asked, id="name").orderBy("rank").collect()] == [(1, "a"), (2, "b")]


def test_ties_at_the_limit():
    rng = np.random.default_rng(1)
    for _ in range(200):
        scores, k = rng.integers(0, 6, rng.integers(1, 40)), int(rng.integers(1, 12))
        assert lexical.best_of(scores, k).tolist() == [i for s, i in sorted((-s, i) for i, s in enumerate(scores) if s > 0)][:k]


def test_a_full_shard_is_closed():
    weighting, shard = lexical.Weighting(3, 9), lexical._Shard()
    import pyarrow as pa

    for i, t in ((5, "b a a"), (None, "a"), (2, "c b a c c")):
        shard.add(pa.array([i], pa.int64()), lexical.terms(t), weighting)
    ids, terms, starts, docs, impacts = (c[0].as_py() for c in shard.row(weighting))
    assert ids == [2, 5, None] and terms == b"b a c"
    starts, docs, impacts = np.frombuffer(starts, "<i4"), np.frombuffer(docs, "<u2"), np.frombuffer(impacts, "<i4")
    assert starts.tolist() == [0, 2, 5, 6] and docs.tolist() == [0, 1, 0, 1, 2, 0]
    assert impacts[3] == 10**9 * 2 // (2000 + 8 * (25 + 75 * 3 * 3 // 9))


def test_search_sql(spark, tmp_path):
    import pandas as pd

    rng = random.Random(9)
    rows = [(i, t) for i, (_, t) in enumerate(documents(rng, 60))]
    items = [(i, rows[rng.randrange(len(rows))][1]) for i in range(15)] + [(2, "same text")]
    pd.DataFrame(rows, columns=["doc_id", "text"]).to_parquet(tmp_path / "documents.parquet")
    pd.DataFrame(items, columns=["item_id", "text"]).to_parquet(tmp_path / "benchmark.parquet")
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet'")
    found = lexical.search(lexical.build(spark.read.parquet(f"{tmp_path}/documents.parquet")), spark.read.parquet(f"{tmp_path}/benchmark.parquet"))
    assert Counter(map(tuple, found.collect())) == Counter(db.execute(lexical.sql()).fetchall()) == ranked(rows, items, 10)


@pytest.fixture(scope="module")
def pieces():
    processor = sentence_pieces.library(sentence_pieces.model_path())
    return sentence_pieces.Pieces(processor), processor


def test_pieces_of_any_text(pieces):
    own, processor = pieces
    rng = random.Random(2)
    alphabet = [*"ab▁ \n\t<0x41>é😀漢字ſ", "the", "   ", "\x00", "퟿", "\U0010ffff", "▁▁", "ing", "<s>", "</s>", "ction"]
    for _ in range(4000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
        ids = processor.encode(text)
        assert own.encode(text) == ids and own.decode(ids) == processor.decode(ids), repr(text)


def test_both_agendas_merge_alike(pieces):
    own, _ = pieces
    rng = random.Random(3)
    for _ in range(2000):
        part = "".join(rng.choice("▁ethiasnorcl漢🙂") for _ in range(rng.randint(1, 50)))
        assert own._merge_listed(part) == own._merge_heaped(part)


def test_agendas_worked_off_together_merge_alike(pieces):
    own, processor = pieces
    rng = random.Random(5)
    parts = ["".join(rng.choice("▁ethiasnorcl漢🙂\n") for _ in range(rng.randint(1, 60))) for _ in range(3000)] + ["▁", "🙂", "e"]
    assert own.encode_parts(parts) == [own.encode_part(p) for p in parts] and own.encode_parts([]) == []
    texts = [" ".join(rng.choices(parts, k=rng.randint(0, 9))) for _ in range(500)]
    assert own.encode_all(texts) == processor.encode(texts)


def test_any_ids_are_decoded_as_by_the_library(pieces):
    own, processor = pieces
    rng = random.Random(4)
    for _ in range(6000):
        ids = [rng.choice((rng.randrange(32000), rng.randrange(3, 259), rng.choice((0, 1, 2, 28705, 259)))) for _ in range(rng.randint(0, 9))]
        assert own.decode(ids) == processor.decode(ids), ids


def test_long_runs_without_spaces(pieces):
    own, processor = pieces
    rng = random.Random(6)
    for text in ("".join(rng.choice("abcdefghinorst") for _ in range(60_000)), "漢字かな" * 20_000, " " * 50_001, "\n" * 5000):
        assert own.encode(text) == processor.encode(text)


def test_where_the_library_differs_its_result_is_given(pieces):
    own, processor = pieces
    wrong = sentence_pieces.Pieces(processor)
    wrong.ranks = {}  # merges nothing
    texts = ["the words", "", " ", "other words there"]
    ids, decoded, agrees = sentence_pieces.checked(texts, wrong, processor)
    assert ids == processor.encode(texts) and decoded == texts and agrees == [False, True, False, False]
    assert sentence_pieces.checked(texts, own, processor)[2] == [True] * 4


def test_sentence_piece_digests(spark, pieces):
    _, processor = pieces
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "the words"), (3, "x ▁y"), (3, "x ▁y")]
    found = sentence_pieces.digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    expected = []
    for i, t in rows:
        ids = processor.encode(t or "")
        expected.append((i, len(ids), sha(",".join(map(str, ids))), sha(processor.decode(ids)), True))
    assert Counter(map(tuple, found)) == Counter(expected)


def resampled(rows, target, percent=5, least=20):
    def features(t):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
        return len(w), [" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]

    def buckets(fs):
        return Counter(zlib.crc32(f.encode()) % 10000 for f in fs)

    own = [(i, *features(t)) for i, t in rows]
    s, t = sum((buckets(f) for _, _, f in own), Counter()), sum((buckets(features(x)[1]) for x in target), Counter())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10000) / ((s[b] + 1) * (t.total() + 10000)))) for b in range(10000)]
    out = []
    for i, n, f in own:
        weight = sum(gain[b] * k for b, k in buckets(f).items())
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    fit = sorted((x for x in out if x[4] >= least), key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    drawn = fit[: percent * len(fit) // 100]
    found = Counter((*x[:4], rank) for rank, x in enumerate(drawn, 1))
    for x in (Counter(o[:4] for o in out) - Counter(o[:4] for o in drawn)).elements():
        found[*x, None] += 1
    return found


@pytest.mark.parametrize("percent", [5, 60])
def test_resampling_by_brute_force(spark, percent):
    rng = random.Random(8)
    rows = documents(rng, 120)
    target = ["w1 w2 w3 the w4", "w1 w2", None, "", "É x1"]
    given, wanted = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(t,) for t in target], "text string")
    found = importance.resample(given.repartition(4), wanted, percent)
    assert Counter(map(tuple, found.collect())) == resampled(rows, target, percent)
    assert importance.resample(given.limit(0), wanted).collect() == []
    assert Counter(map(tuple, importance.resample(given, wanted.limit(0)).collect())) == resampled(rows, [])


def test_texts_of_several_segments(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(importance, "SEGMENT_WORDS", 7)
    texts = [" ".join(f"w{i % 5}" for i in range(n)) for n in (0, 1, 6, 7, 8, 9, 30)]
    words, (row, bucket, n) = importance.bucket_counts(importance.connection(), pa.array(texts))
    assert words.tolist() == [0, 1, 6, 7, 8, 9, 30]
    for k, t in enumerate(texts):
        w = t.split()
        assert dict(zip(bucket[row == k].tolist(), n[row == k].tolist(), strict=True)) == Counter(zlib.crc32(" ".join(w[i : i + g]).encode()) % 10000 for g in (1, 2, 3) for i in range(len(w) - g + 1))
