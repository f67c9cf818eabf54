import hashlib
import random
import struct

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from txguard.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", "  ", "<|endoftext|>a", "x<|startoftext|><|endoftext|>Y <| z", "ΑΣ ΣΑΣ", "İstanbul é é", "a\x1cb\x1fc\x85d e　f",
       "a" * 300 + "!" * 50, "日本語テキスト 123 ½ ²", "it's they'll 'S 'T", "ﬁ ǅ", "﻿x​y", "word " * 5000]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(
        library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_like_the_library(library):
    random.seed(3)
    letters = "abcdefghijklmnopqrstuvwxyzthineranesàéüßñç'!.,-1 \t\nŞİΣжщ中😀́ "
    texts = ODD + ["".join(random.choices(letters, k=random.randint(1, 80))) for _ in range(3000)]
    encoder = bpe.Encoder(open(PATH, encoding="utf-8").read(), cache_words=500)
    for at in range(0, len(texts), 100):
        for text, (ids, decoded) in zip(texts[at:at + 100], encoder.encode(texts[at:at + 100])):
            own = library.encode(text, add_special_tokens=False).ids
            assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == own, text
            assert decoded == library.decode(own, skip_special_tokens=False)


def test_digests_of_all_rows(documents, clashing, library):
    docs = [(i, t) for i, t in enumerate(ODD)] + [(100, None), (100, None), (None, "a b")]
    found = bpe.digests(clashing(documents(*docs)), PATH).collect()
    assert sorted(map(str, ((r[0], *r[1:]) for r in found))) == sorted(str((i, *expected(library, t))) for i, t in docs)
    assert bpe.digests(documents(), PATH).count() == 0


def test_whole_table(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in bpe.digests(docs, PATH).collect():
        assert tuple(r)[1:] == expected(library, texts[r["doc_id"]])


def test_ids_and_text(documents, library):
    r = bpe.encode(documents((1, "Hello there")), PATH, ["doc_id"]).first()
    assert r["ids"] == library.encode("Hello there", add_special_tokens=False).ids and r["decoded"] == library.decode(r["ids"])
