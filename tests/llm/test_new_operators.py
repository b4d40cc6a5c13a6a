"""Fill-in-the-middle, token files and centroid clustering against plain versions, and on odd rows."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegrid.llm import fim, tokenfiles, vafile
from tidegrid.llm.eliasfano import EliasFano
from tidegrid.llm.queries import LLM_QUERIES
from tidegrid.llm.tokens import ByteEncoder, tokenizer_path
from tidegrid.session import scratch_path

LONG = "word, another\n" * 80_000
ROWS = [
    (1, "the cat sat, on the mat"),
    (2, "the cat sat, on the mat"),
    (2, "the cat sat, on the mat"),
    (2, "another text of the same id"),
    (3, ""),
    (4, None),
    (5, " \n\t "),
    (6, "x" * 300_000),
    (7, LONG),
    (8, "with <S> a marker"),
    (9, "é日本 İ, <P ends in <"),
    (None, "without an id"),
    (None, None),
    (-(1 << 62), "S> starts so"),
    ((1 << 62) + 1, "M>"),
    *[(i, f"text number {i} <" * (i % 7)) for i in range(20, 80)],
]
CLASHING = ["n", "form", "_text", "_h1", "_cut", "file", "task", "hash", "start", "output", "place"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string").select("*", *[F.lit("x").alias(c) for c in CLASHING])


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def plain_fim(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    low, high = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle(docs, none):
    cut = fim.fill_in_middle(docs).withColumn("restored", fim.restore(F.col("output"), F.col("form")))
    got = sorted((tuple(r) for r in cut.collect()), key=repr)
    assert got == sorted(((i, *plain_fim(i, t), t or "") for i, t in ROWS), key=repr)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    assert fim.fill_in_middle(none).count() == 0


@pytest.mark.parametrize("text", ["", "abc", "a b", "ab, c" * 9, "é a1\n\n", "x" * 50 + "!", "!" * 50, "a" * 10 + "1" * 10])
@pytest.mark.parametrize("block", [1, 7, 1000])
def test_units_of_long_texts(text, block):
    assert fim.unit_ends(text, block).tolist() == [m.end() for m in re.finditer(r"[A-Za-z]+|[^A-Za-z]", text)]


@pytest.mark.parametrize("form", ["psm", "spm"])
def test_markers_that_touch_parts(spark, form):
    """Parts that begin or end with pieces of markers do not mislead the way back."""
    parts = ["", "<", "<S", "S>", "<P", "M>", "<<", ">", "<M"]
    rows = [(p, m, s) for p in parts for m in parts for s in parts]
    df = spark.createDataFrame(rows, "p string, m string, s string")
    joined = {"psm": F.concat(F.lit("<P>"), "p", F.lit("<S>"), "s", F.lit("<M>"), "m"), "spm": F.concat(F.lit("<S>"), "s", F.lit("<P>"), "p", F.lit("<M>"), "m")}
    back = df.select(F.concat("p", "m", "s").alias("text"), fim.restore(joined[form], F.lit(form)).alias("back"))
    whole = back.filter(~F.col("text").rlike("<[PSM]>"))  # others stay plain
    assert whole.count() > 500 and whole.filter("text <> back").count() == 0


@pytest.mark.parametrize(("count", "top"), [(0, 0), (1, 0), (1, 9), (7, 0), (64, 63), (1000, 1000), (3000, (1 << 64) - 1), (30_000, 10**9)])
def test_elias_fano(count, top):
    rng = np.random.default_rng(count)
    values = np.sort(rng.integers(0, top, count, dtype=np.uint64, endpoint=True))
    coded = EliasFano.of(values)
    anywhere = rng.permutation(count)
    assert (coded[np.arange(count)] == values).all() and (coded[anywhere] == values[anywhere]).all()
    if count >= 1000:
        size = 8 * (coded.low.nbytes + coded.high.nbytes + coded.before.nbytes) / count
        assert size < np.log2(max(2, top / count)) + 4


def plain_ids(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    return [tokenizer.encode(text or "", add_special_tokens=False).ids for text in texts]


def test_encoder():
    rng = np.random.default_rng(5)
    pieces = ["a", " ", "  ", "\n", "\n\n", "\t", "don't", "é", "１", "\x1c", "\x85", "<|endoftext|>", "!?", "12", "　", "İ", " 's", " x", "日本", "x\ny", "'Twas", "y" * 60]
    texts = ["".join(rng.choice(pieces, rng.integers(0, 12))) for _ in range(3000)] + [t or "" for _, t in ROWS]
    encoder = ByteEncoder(tokenizer_path("byte_bpe_50k.json"))
    for _ in range(2):  # also when all parts are known
        assert [np.frombuffer(ids, encoder.kind).tolist() for ids in encoder.encode(texts)] == plain_ids(texts)


def test_whole_table_of_token_files(spark, sf_dir):
    """Every row of the query against the tokenizer and a running sum."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").toPandas().sort_values("doc_id")
    expected, start = [], 0
    for doc_id, ids in zip(rows.doc_id, plain_ids(rows.text)):
        raw = np.array([*ids, 0], "<u4").tobytes()
        expected.append((doc_id, start, len(ids) + 1, zlib.crc32(raw)))
        start += len(ids) + 1
    assert sorted(tuple(r) for r in LLM_QUERIES["op12_token_files"](spark, sf_dir).collect()) == expected


@pytest.mark.parametrize(("file_ids", "file_documents", "read"), [(1 << 25, 1 << 22, 1 << 16), (50, 5, 3)])
def test_token_files(spark, docs, none, monkeypatch, file_ids, file_documents, read):
    monkeypatch.setattr(tokenfiles, "FILE_IDS", file_ids)
    monkeypatch.setattr(tokenfiles, "FILE_DOCUMENTS", file_documents)
    monkeypatch.setattr(tokenfiles, "READ_DOCUMENTS", read)
    monkeypatch.setattr(tokenfiles, "READ_IDS", file_ids)
    path, folder = tokenizer_path("byte_bpe_50k.json"), scratch_path(spark, "tokens")
    manifest = tokenfiles.write_tokens(docs, folder, path, tasks=3)
    got = tokenfiles.read_documents(spark, manifest, folder).orderBy("start").collect()
    # Nulls first, then by id; within an id the texts in any order, but all of them.
    assert [r.doc_id for r in got] == [None, None, *sorted(i for i, _ in ROWS if i is not None)]
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1]]
    expected = [(i, zlib.crc32(np.array([*ids, 0], "<u4").tobytes())) for (i, _), ids in zip(ROWS, plain_ids(t for _, t in ROWS))]
    assert sorted(((r.doc_id, r.ids_crc32) for r in got), key=repr) == sorted(expected, key=repr)
    # A document by its number, read on its own.
    first = manifest.orderBy("task", "part").first()
    with tokenfiles.TokenFile(f"{folder}/{first.file}") as tokens:
        assert tokens.documents == first.documents and tokens.ids == first.ids
        for number in range(min(3, tokens.documents)):
            assert zlib.crc32(tokens.document(number).astype("<u4").tobytes()) == got[number].ids_crc32
    empty = tokenfiles.write_tokens(none, scratch_path(spark, "tokens"), path)
    assert empty.count() == 0 and tokenfiles.read_documents(spark, empty, folder).count() == 0


def test_cut_off_token_file(spark, tmp_path):
    (tmp_path / "cut.bin").write_bytes(b"\0" * 500)
    with pytest.raises(ValueError, match="not a whole token file"):
        tokenfiles.TokenFile(str(tmp_path / "cut.bin"))


def plain_clusters(rows, k=8, rounds=10, dims=64):
    kept = [(i, np.floor(1024 * np.array(v, float)).astype(int).tolist()) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        members = [[] for _ in centroids]
        for _, v in kept:
            members[nearest(v)[1]].append(v)
        centroids = [[sum(x) // len(m) for x in zip(*m)] if m else c for m, c in zip(members, centroids)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    inertia = [sum(d for _, c, d in found if c == j) for j in range(len(centroids))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, inertia[c], sum(inertia), digest[c]) for i, c, d in found), key=repr)


def odd_vectors():
    rng = np.random.default_rng(3)
    bad = [None, [], [1.0] * 63, [1.0] * 65, [1.0] * 63 + [None], [1.0] * 63 + [float("nan")], [float("-inf")] + [1.0] * 63]
    rows = [(i, v) for i, v in enumerate(bad)] + [(None, [0.25] * 64)]
    rows += [(100, [0.5] * 64)] * 40 + [(101 + i, [-0.5] * 64) for i in range(40)]  # repeated rows and ties
    rows += [(200 + i, (rng.normal(size=64) / 8).tolist()) for i in range(150)]
    return rows + [(400, [200.0] * 64), (401, [-1e-30] * 64)]


def test_clusters_of_odd_vectors(spark):
    rows = odd_vectors()
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    table = table.select("*", *[F.lit("x").alias(c) for c in ("vector", "cells", "hash", "cluster", "place", "kind")])
    plain = plain_clusters([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows])
    for bits in (1, 3, 8):
        got = vafile.cluster_vectors(table, bits=bits)[0]
        assert sorted((tuple(r) for r in got.collect()), key=repr) == plain


def test_few_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    none, centroids = vafile.cluster_vectors(spark.createDataFrame([], schema))
    assert none.count() == 0 and centroids == [] and len(none.columns) == 6
    three = [(i, [float(i)] * 64) for i in range(3)]
    got, centroids = vafile.cluster_vectors(spark.createDataFrame(three, schema))
    assert sorted(tuple(r) for r in got.collect()) == plain_clusters(three) and len(centroids) == 3
    assert vafile.cluster_vectors(spark.createDataFrame([(1, None)], schema))[0].count() == 0


def test_too_long_vectors_are_left_out(spark):
    rows = [(1, [0.5] * 64), (2, [300_000.0] + [0.0] * 63), (3, [1e30] * 64)]
    got = vafile.cluster_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))[0]
    assert [r.vec_id for r in got.collect()] == [1]


def test_intervals_hold_and_spare_vectors(spark, sf_dir):
    """The distance of every centroid lies in its interval, and most vectors are not fetched."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    values = np.floor(1024 * np.stack(rows.embedding).astype(float)).astype(np.int64)
    space = vafile.Approximations("unused", 64, vafile.cell_edges(values, 8), values.min(0), values.max(0))
    cells, squared = vafile.cells_of(values, space.edges), (values**2).sum(1)
    centroids = np.stack([values[i::8].sum(0) // len(values[i::8]) for i in range(8)])
    intervals = vafile.Intervals(space, centroids)
    exact = ((values[:, None, :] - centroids) ** 2).sum(2)
    total = sum(table[cells[:, d]] for d, table in enumerate(intervals.tables))
    low, high = (total[:, part] + squared[:, None] + intervals.squared for part in (slice(0, 8), slice(8, 16)))
    assert (low <= exact).all() and (exact <= high).all()
    may = intervals.candidates(cells, squared)
    assert may[np.arange(len(values)), exact.argmin(1)].all() and (may.sum(1) == 1).mean() > 0.5
