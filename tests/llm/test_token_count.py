import random

import numpy as np
import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from jobloom.llm import tokencount as tc  # noqa: E402
from jobloom.llm.batches import texts_of  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def counts(texts, machine=None, limit=1 << 21):
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    machine = machine or tc.tokenizer(PATH)
    return [n for t in texts_of(batch, "text", limit) for n in machine.count(t).tolist()]


def expected(library, texts):
    return [len(e.ids) for e in library.encode_batch([t or "" for t in texts],
                                                     add_special_tokens=False)]


CASES = ["", None, "a  b", "a \n b", "   ", "it's", "'s", "'re 'r 'rx 'l 'll 'lx", "x'", "'", "' s",
         "don't'll've'd!'s", "<|endoftext|>", "a <|endoftext|> b", "  <|endoftext|>x", "a" * 5000,
         "=" * 3000, " " * 500 + "x", "\n\n\n x", "a\t\tb", "漢字かな交じり文 ١٢٣ Ⅷ ½", "é́", "  x"]


def test_cases(library):
    assert counts(CASES) == expected(library, CASES)
    assert counts(CASES, limit=1) == expected(library, CASES)


def test_every_kind_of_character(library):
    texts = [f"a{chr(i)} {chr(i)}1 {chr(i)}b" for i in range(1, 0x30000, 7)
             if not 0xD800 <= i < 0xE000]
    assert counts(texts) == expected(library, texts)


def test_random_texts(library):
    draw = random.Random(1)
    texts = ["".join(draw.choice("'srevlltmd  \n\t.!1aé漢<|>") for _ in range(draw.randint(0, 40)))
             for _ in range(5000)]
    assert counts(texts) == expected(library, texts)


def test_chunks_of_one_text(library):
    draw = random.Random(2)
    text = "".join(draw.choice("'sre  \n.1aé") for _ in range(5 * tc.CHUNK + 3))
    assert counts([text]) == expected(library, [text])


def test_full_table_begins_anew(library):
    machine = tc.FiniteStateTokenizer(PATH)
    machine.machine.limit = 40
    machine.machine.reset()
    texts = CASES[:10] + ["of the thing that was there before others came"]
    assert counts(texts, machine, limit=1) == expected(library, texts)


@pytest.mark.parametrize("size, limit", [(16, 1 << 17), (40, 1 << 17), (200, 1 << 17), (16, 1 << 30)])
def test_long_token_whose_prefixes_are_single_bytes(size, limit):
    whole = bytes(range(33, 33 + size))
    tokens = {bytes([b]): b for b in range(256)}
    ranks = {}
    for at in range(size - 2, -1, -1):
        ranks[whole[at:at + 1], whole[at + 1:]] = len(ranks)
        tokens[whole[at:]] = 256 + len(ranks)
    machine = tc.CountMachine(tokens, ranks, limit)
    data = [whole + whole[:-1] + b"!" + whole + b"x", whole[:-1], whole, whole * 3]
    joined = np.frombuffer(b"".join(data), np.uint8)
    lengths = np.array([len(d) for d in data])
    found = machine.counts(joined, np.cumsum(lengths) - lengths, lengths)
    assert found.tolist() == [len(machine.merged(d)) for d in data]


def test_operator(spark, library):
    rows = [(1, "one two", "x"), (1, "one two", "y"), (None, None, None), (4, "", "z")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string")
    found = sorted(map(tuple, tc.token_counts(df, PATH, limit=1).collect()), key=str)
    two = expected(library, ["one two"])[0]
    assert found == sorted([(1, 7, two, True), (1, 7, two, True), (None, 0, 0, False),
                            (4, 0, 0, False)], key=str)
    assert tc.token_counts(df.limit(0), PATH).count() == 0
