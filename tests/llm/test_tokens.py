"""Token files and packing against the library's own encoding."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF_DIR
from opsward.llm.packing import Limits, Packer, pack
from opsward.llm.queries import QUERIES
from opsward.llm.token_files import open_shard, read_token_files, write_token_files
from opsward.llm.tokens import Encoder

ODD = [
    "", " ", "  ", "a  b", "\n\n x", " 's it's don't!'s", "a\xa0b x\n\n b", "foo\n\n\nbar", "\nfoo", "foo\n", " foo", "foo.bar,, 'Foo' FOO...",
    "x<|endoftext|>y", "\x1c! a\x1d", "12 34abc\t\tfoo \r\n bar  ", "-foo a- !x Ünß\nÉ", "ΑΣ Σ é ́ İ", "日本語 テキスト", "word " * 3000,
]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_equal_the_library(name):
    path = public_tokenizers.path(name)
    whole, own = Tokenizer.from_file(path), Encoder(path)
    for text in ODD + ODD[::-1]:
        assert own.ids(text).tolist() == [*whole.encode(text, add_special_tokens=False).ids, 2], repr(text)


CLOSING = ["a\n\n", "\n\n", "a\n", "\n", "a\n\nb", "a\n\nb\n\n", "a.\n\n", "a b\n\n", "\n\na"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_of_line_breaks_and_random_texts_equal_the_library(name):
    path = public_tokenizers.path(name)
    whole, own, rng = Tokenizer.from_file(path), Encoder(path), np.random.default_rng(3)
    parts = [" ", " ", "\n", "\n", "\n\n", "a", "foo", "Bar", "é", ".", ",", "'s", "-", "7"]
    texts = ["".join(rng.choice(parts, n)) for n in rng.integers(1, 14, 6000)]
    for text in CLOSING + texts:
        assert own.ids(text).tolist() == [*whole.encode(text, add_special_tokens=False).ids, 2], repr(text)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_a_worker_remembers_only_pieces_that_come_again(name):
    path = public_tokenizers.path(name)
    whole, own = Tokenizer.from_file(path), Encoder(path)
    spelt = [f"{a}{b}{c}{tail}" for a in "bcdfghjklm" for b in ("ana", "eri", "ou", "Ix") for c in "nprstvwxyz" for tail in ("", ".", ",&", "7")]
    once, often = " ".join(spelt), "Foo bar\nfoo, bar. foo"
    for text in [once, often, often, often, once]:
        before = len(own._known)
        assert own.ids(text).tolist() == [*whole.encode(text, add_special_tokens=False).ids, 2]
        if text is once and not before:
            assert len(own._known) < len(spelt) / 10
    assert len(own._known) >= len(spelt)


def fixture(spark):
    rows = [(i * 7 % 5, t, "x", "y") for i, t in enumerate([*ODD, *ODD[:4]])] + [(None, None, None, None), (99, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, start string, key string").repartition(3)


def test_token_files_round_trip(spark):
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    docs = fixture(spark)
    manifest = write_token_files(docs, tokenizer)
    got = sorted(read_token_files(manifest).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got if r.doc_id is not None] == sorted(r.doc_id for r in docs.collect() if r.doc_id is not None)
    assert got[0].doc_id is None and got[0].n_tokens == 1
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got[:-1])]).tolist()
    whole = Tokenizer.from_file(tokenizer)
    wanted = sorted((r.doc_id or -1, crc([*whole.encode(r.text or "", add_special_tokens=False).ids, 2])) for r in docs.collect())
    assert sorted((r.doc_id or -1, r.ids_crc32) for r in got) == wanted
    keys, ends, ids = open_shard(*[(m.root, m.shard, m.width) for m in manifest.where("docs > 0").collect()][0])
    assert ids.dtype == np.uint16 and ends[-1] == len(ids) and len(keys) == len(ends)


def test_token_files_of_nothing(spark):
    manifest = write_token_files(fixture(spark).limit(0), public_tokenizers.path("byte_bpe_50k.json"))
    assert read_token_files(manifest).count() == 0


def test_op1_whole_table(spark):
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    wanted, start = [], 0
    for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").collect():
        ids = [*whole.encode(r.text or "", add_special_tokens=False).ids, 2]
        wanted.append((r.doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(map(tuple, QUERIES["op1_token_files"](spark, SF_DIR).collect())) == wanted


def check_pieces(pieces, ids_of, limits, cut=True):
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert by_doc.keys() == ids_of.keys()
    for doc, own in by_doc.items():
        at = 0
        for p in sorted(own, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids_of[doc])
            assert p.ids_crc32 == crc(ids_of[doc][at : at + p.length])
            at += p.length
        assert at == len(ids_of[doc])
    for own in by_sequence.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == np.cumsum([0, *(p.length for p in own[:-1])]).tolist()
        total = sum(p.length for p in own)
        assert total <= limits.tokens and len(own) <= limits.segments and sum(p.loss_tokens for p in own) <= limits.loss
        if cut:
            assert total & (total - 1) == 0 or total == limits.tokens


@pytest.mark.parametrize("limits", [Limits(), Limits(64, 3, 40), Limits(16, 1000, 16)])
def test_pieces_cover_each_document_once(spark, limits):
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(tokenizer)
    docs = fixture(spark).withColumn("doc_id", F.monotonically_increasing_id())
    docs = spark.createDataFrame(docs.collect(), docs.schema).repartition(2)
    ids_of = {r.doc_id: [*whole.encode(r.text or "", add_special_tokens=False).ids, 2] for r in docs.collect()}
    check_pieces(pack(docs, tokenizer, limits, bears_loss=F.col("doc_id") % 2 == 0).collect(), ids_of, limits)
    assert pack(docs.limit(0), tokenizer, limits).count() == 0


def test_op6_whole_table(spark):
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    ids_of = {r.doc_id: [*whole.encode(r.text or "", add_special_tokens=False).ids, 2] for r in docs}
    check_pieces(QUERIES["op6_packing"](spark, SF_DIR).collect(), ids_of, Limits())


def test_null_and_repeated_ids_are_examples_of_their_own(spark):
    docs = spark.createDataFrame([(None, "a b"), (None, None), (1, "a b"), (1, "a b")], "doc_id long, text string")
    got = pack(docs, public_tokenizers.path("word_bpe_49k.json")).collect()
    assert sum(p.length for p in got) == 3 + 1 + 3 + 3


def test_without_cutting_examples_stay_whole():
    rng = np.random.default_rng(5)
    packer = Packer(Limits(100, 5, 60), cut=False)
    lengths = rng.integers(1, 61, 300)
    done = []
    for i, n in enumerate(lengths):
        done += packer.add(i, int(n), i % 2 == 0)
    done += packer.fill(last=True)
    assert sorted(p[0] for s in done for p in s) == list(range(300))
    for s in done:
        assert sum(p[2] for p in s) <= 100 and len(s) <= 5 and sum(p[2] * p[3] for p in s) <= 60
    with pytest.raises(ValueError):
        list(packer.add(0, 101, True))
