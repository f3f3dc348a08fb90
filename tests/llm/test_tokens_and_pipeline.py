"""Token files, the piece transducer and the pipeline: round trips and the libraries' results."""

import random
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shoal.llm import pieces, queries, tokens

SF = "/root/testdata/sf0.001"
ODD = ["a", "B", "é", "É", "ß", "'s", "'", ".", ",", " ", "  ", "\n", "\t", "ñ", "7", "À", "日", "́", " ", "<|endoftext|>", "$", "€", "ſ",
       "K", "İ", "Σ", "_", "-", "!", "▁", "😀", "th", "ing", "The", "<0x41>", "</s>"]


def strings(seed, n, most=20):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ODD) for _ in range(rnd.randint(0, most))) for _ in range(n)] + [" " * k for k in range(40)]


def test_word_encoder_is_the_library():
    from tokenizers import Tokenizer

    with open(queries.tokenizer_file("word_bpe_49k.json"), encoding="utf-8") as f:
        model = f.read()
    enc, lib = tokens.WordEncoder(model), Tokenizer.from_str(model)
    for x in strings(1, 3000):
        assert np.frombuffer(enc(x.encode()), enc.kind).tolist() == lib.encode(x, add_special_tokens=False).ids, repr(x)


def expected(rows):
    from tokenizers import Tokenizer

    lib, out, start = Tokenizer.from_file(queries.tokenizer_file("word_bpe_49k.json")), [], 0
    for i, t in rows:
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 1]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_files_of_documents(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()
    assert sorted(tuple(r) for r in queries.op9_token_files(spark, SF).collect()) == expected(rows)


def test_token_file_cases(spark, tmp_path):
    rows = [(None, "zero"), (1, None), (2, ""), (3, "tied b"), (3, "tied c"), (3, "tied c"), (4, "word " * 100_000)]
    df = spark.createDataFrame([(*r, 1) for r in rows[::-1]], "doc_id long, text string, key int")
    folder = str(tmp_path / "files")
    manifest = tokens.write(df, folder, queries.tokenizer_file("word_bpe_49k.json"), end_id=1)
    got = sorted((tuple(r) for r in tokens.read(spark, manifest, folder, "bigint").collect()), key=lambda r: r[1])
    assert got == expected(rows)
    ids = {r["doc_id"]: r["ids"] for r in tokens.documents(spark, manifest, folder, "bigint").collect()}
    assert ids[1] == ids[2] == [1] and len(ids[4]) == 100_001
    none = tokens.write(df.limit(0), str(tmp_path / "none"), queries.tokenizer_file("word_bpe_49k.json"), end_id=1)
    assert none.count() == 0 and tokens.read(spark, none, str(tmp_path / "none"), "bigint").count() == 0


def test_piece_transducer_is_the_library():
    import sentencepiece

    path = queries.tokenizer_file("piece_bpe_32k.model")
    lib, t = sentencepiece.SentencePieceProcessor(model_file=path), pieces.Transducer(pieces.compiled(path))
    for x in strings(2, 4000):
        ids = np.frombuffer(t.encode(x), "<i4").tolist()
        assert ids == lib.encode(x), repr(x)
        assert t.decode(ids).decode() == lib.decode(ids) == x.replace(pieces.SPACE, " ")


def _model(scores: dict, kind: int) -> bytes:
    """A model file: unknown piece, then the given normal pieces."""
    import struct

    def field(n, body):
        return bytes([n << 3 | 2]) + _varint(len(body)) + body

    piece = lambda text, score, typ: field(1, field(1, text.encode()) + b"\x15" + struct.pack("<f", score) + b"\x18" + bytes([typ]))
    body = piece("<unk>", 0.0, 2) + b"".join(piece(p, s, 1) for p, s in scores.items())
    return body + field(2, b"\x18" + bytes([kind])) + field(3, b"\x18\x01\x20\x00")


def _varint(n):
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def test_unigram_paths_are_the_cheapest_of_all():
    scores = {"▁": -2.0, "a": -2.1, "b": -2.3, "ab": -3.0, "▁a": -2.5, "ba": -3.3, "bab": -4.1, "▁ab": -4.4, "aba": -4.0}
    t = pieces.Transducer(_model(scores, pieces.UNIGRAM))

    def best(text):
        if not text:
            return 0.0
        return min((-s + best(text[len(p):]) for p, s in scores.items() if text.startswith(p)), default=float("inf"))

    rnd = random.Random(4)
    for _ in range(60):
        x = "".join(rnd.choice("ab") for _ in range(rnd.randint(1, 8)))
        ids = np.frombuffer(t.encode(x), "<i4").tolist()
        assert t.decode(ids).decode() == x
        assert sum(t.cost[i] for i in ids) == pytest.approx(best("▁" + x), abs=1e-5)
    assert np.frombuffer(t.encode("aZZb"), "<i4").tolist().count(t.unk) == 1


def test_pieces_cases(spark):
    path = queries.tokenizer_file("piece_bpe_32k.model")
    texts = [None, "", " ", "x" * 50_000, "same text", "same text", "日本 😀\n\ttab"]
    df = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id int, text string, raw_text int")
    both = pieces.decode(pieces.encode(df, path), path)
    assert both.columns == [*df.columns, "ids", "decoded"]
    got = {r["doc_id"]: r for r in both.collect()}
    assert got[0]["ids"] is None and got[0]["decoded"] is None and got[1]["ids"] == [] and got[4]["ids"] == got[5]["ids"]
    assert all(got[i]["decoded"] == t for i, t in enumerate(texts))
    assert pieces.encode(df.limit(0), path).count() == 0


def test_pieces_of_a_column_are_decoded_as_one_by_one():
    t = pieces.Transducer(pieces.compiled(queries.tokenizer_file("piece_bpe_32k.model")))
    lists = [None, [], *(np.frombuffer(t.encode(x), "<i4").tolist() for x in ("one", "", " two  é", "\U0001f600 x\n"))]
    col = pa.array([[5, 6], *lists, None, [7]], pa.list_(pa.int32()))
    for part in (col, col[1:], col[1:-1], col[:0]):
        assert t.decode_all(part) == [None if x is None else t.decode(x) for x in part.to_pylist()]


def test_pieces_query_round_trips(spark):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer_file("piece_bpe_32k.model"))
    src = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    for r in queries.op10_sentencepiece(spark, SF).collect():
        assert r["round_trip"] and r["ids"] == lib.encode(src[r["doc_id"]]) and r["n_ids"] == len(r["ids"])


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    text = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    labels = {r[0]: r[1:] for r in duckdb.sql(f"SELECT * FROM '{SF}/labels.parquet'").fetchall()}
    for k, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if k < len(P.STAGES) - 1:
            assert docs.columns == columns
        now = docs.count()
        assert 0 < now <= before
        if name == "line_dedup":
            assert now == before
        if name == "quality_classifier":
            kept = {r["doc_id"] for r in docs.select("doc_id").collect()}
            clean = [i for i, (q, t) in labels.items() if q == 1 and t == 0]
            assert sum(i in kept for i in clean) >= 0.95 * len(clean)
        before = now
    assert docs.columns == [*columns, "ids"] and set(text) >= {r["doc_id"] for r in docs.select("doc_id").collect()}


def test_pipeline_is_a_query():
    import __spark_entry__ as E

    assert E.queries()["pipeline"] is E.CP.run and "pipeline" not in E.oracle_sql()
    assert [n for n in E.queries() if n.startswith("op")] == list(queries.QUERIES)
    assert [int(n[2:].split("_")[0]) for n in queries.QUERIES] == list(range(1, 14))


def test_pipeline_query_on_odd_documents(spark, tmp_path):
    """The registered query over documents with nulls, empty, very long and repeated texts, ties,
    repeated rows and columns named as the operators name theirs; then over an empty table."""
    import __spark_entry__ as E

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    long = " ".join(f"q{i}x{i * 7919 % 1013}" for i in range(60_000))
    fresh = "one plain line about nothing much that no other text in here has\nand a second line of plain words"
    odd = [(90_001, None), (90_002, ""), (90_003, " \n "), (90_004, long), (90_005, fresh), (90_005, fresh), (90_006, fresh), (None, fresh + " end")]
    more = spark.createDataFrame([(i, t, None, None, None) for i, t in odd], docs.schema)
    both = docs.union(more)
    for c in ("ids", "verdict", "gone", "node", "component", "decontam", "h1"):
        both = both.withColumn(c, F.lit("mine"))
    for name, df in (("some", both), ("none", both.limit(0))):
        df.write.parquet(str(tmp_path / name / "documents.parquet"))
        for t in ("labels", "benchmark"):
            spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(str(tmp_path / name / f"{t}.parquet"))
    out = E.queries()["pipeline"](spark, str(tmp_path / "some"))
    assert out.columns == [*docs.columns, "verdict", "gone", "node", "component", "decontam", "h1", "ids"]
    rows = {r["doc_id"]: r for r in out.collect()}
    assert {r["gone"] for r in rows.values()} == {"mine"} and len(rows) <= both.count()
    assert rows[90_001]["ids"] is None and rows[90_002]["ids"] == [] and {90_003, 90_004} <= set(rows)
    assert rows[90_004]["text"] == long and len(rows[90_004]["ids"]) > 60_000
    assert {90_005, 90_006, None} & set(rows)  # the first of the copies stays, whichever its id
    clean = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1 AND toxic = 0").collect()}
    assert len(clean & set(rows)) >= 0.6 * len(clean)  # copies and contaminated ones aside
    assert E.queries()["pipeline"](spark, str(tmp_path / "none")).count() == 0
