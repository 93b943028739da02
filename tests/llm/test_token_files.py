import random

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from boxframe.llm import token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_words_joined_equal_whole_texts():
    plain = Tokenizer.from_file(PATH)
    texts = [
        "", " ", "a", " a", "a ", "a  b", "a \n b", "tab\t x", "x  y", "it's John 's", "<|endoftext|> a <|endoftext|>b", "日本 語 😀 x",
        "end\n next", "many   spaces   here", "\x1c a", "word " * 3000, "line.\nNext line\n\nlast", "a b c",
    ]
    for kind in ("<u2", "<u4"):
        encoder = token_files.WordEncoder(PATH, kind)
        for _ in range(2):
            ids, sizes = encoder.batch(pa.array(texts))
            got = [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
            assert ids.dtype == np.dtype(kind) and got == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_forgetting_words_and_end_ids(monkeypatch):
    monkeypatch.setattr(token_files, "MEMO", 50)
    plain, rng = Tokenizer.from_file(PATH), random.Random(3)
    encoder = token_files.WordEncoder(PATH, "<u4", 2)
    for _ in range(20):
        texts = ["".join(rng.choice("ab \n\té") for _ in range(rng.randint(0, 40))) for _ in range(30)]
        ids, sizes = encoder.batch(pa.array(["unused", *texts]).slice(1))
        want = [[*plain.encode(t, add_special_tokens=False).ids, 2] for t in texts]
        assert sizes.tolist() == [len(x) for x in want] and ids.tolist() == sum(want, [])
    ids, sizes = encoder.batch(pa.array([], pa.string()))
    assert len(ids) == len(sizes) == 0


def test_files_round_trip(spark):
    plain = Tokenizer.from_file(PATH)
    rows = [(i * 3 % 100, f"text number {i} " * (i % 5), "x") for i in range(100)] + [(None, "no id", "x"), (5, None, "x"), (5, "long " * 20_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(6)
    manifest = token_files.write_tokens(docs, PATH, end_id=2)
    got = sorted(token_files.read_tokens(manifest).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda x: (x is not None, x))
    assert [r.start for r in got] == np.concatenate([[0], np.cumsum([r.n_tokens for r in got])[:-1]]).tolist()
    wanted = sorted((i is not None, i or 0, [*plain.encode(t or "", add_special_tokens=False).ids, 2]) for i, t, _ in rows)
    assert sorted((r.doc_id is not None, r.doc_id or 0, np.frombuffer(r.tokens, "<u4").tolist()) for r in got) == wanted
    wide = token_files.read_tokens(token_files.write_tokens(docs, PATH, end_id=2, wide=True))
    assert sorted(bytes(r.tokens) for r in wide.collect()) == sorted(bytes(r.tokens) for r in got)


def test_width_follows_the_vocabulary(spark, tmp_path):
    large = Tokenizer.from_file(PATH)
    large.add_tokens([f"<x{i}>" for i in range(20_000)])
    large.save(f"{tmp_path}/large.json")
    docs = spark.createDataFrame([(1, "a <x19999> b"), (2, "c")], "doc_id long, text string")
    manifest = token_files.write_tokens(docs, f"{tmp_path}/large.json", end_id=2)
    got = {r.doc_id: np.frombuffer(r.tokens, "<u4").tolist() for r in token_files.read_tokens(manifest).collect()}
    wanted = large.encode("a <x19999> b", add_special_tokens=False).ids
    assert max(wanted) > 0xFFFF and got == {1: [*wanted, 2], 2: [*large.encode("c", add_special_tokens=False).ids, 2]}
    assert manifest.first().wide and not token_files.write_tokens(docs, PATH, end_id=2).first().wide


def test_files_are_read_by_several_tasks(spark):
    docs = spark.range(400).selectExpr("id as doc_id", "repeat('word ', 50) as text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = token_files.write_tokens(docs, PATH, end_id=2)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert manifest.count() > 1 and token_files.read_tokens(manifest).rdd.getNumPartitions() == manifest.count()


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_files.read_tokens(token_files.write_tokens(docs, PATH)).count() == 0
