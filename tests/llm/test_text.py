"""Words, windows and hashes against plain Python."""

import random

import numpy as np
import pyarrow as pa
import pytest

from creditloom.llm import packing, text
from tests.llm import plain

ALPHABET = "aB'sSd t1.,…é́ ² \n\t<|x>中'ré re't ll≠ǅ"


def _texts(seed, n=200, most=80):
    pick = random.Random(seed)
    return ["".join(pick.choice(ALPHABET) for _ in range(pick.randint(0, most))) for _ in range(n)]


def _bytes(texts):
    return text.as_bytes(pa.array(texts, pa.string()))


def test_words_do_not_cross_texts():
    texts = _texts(1) + [None, "", "one", "two"]
    raw, off = _bytes(texts)
    starts, ends, first = text.words(raw, off, text.BLANK_SEPARATED)
    found = [[raw[s:e].tobytes() for s, e in zip(starts[a:b], ends[a:b])] for a, b in zip(first[:-1], first[1:])]
    assert found == [plain.blank_words(t) for t in texts]


def test_equal_words_have_equal_hashes():
    raw, off = _bytes(_texts(2))
    starts, ends, _ = text.words(raw, off, text.BLANK_SEPARATED)
    hashes = text.range_hash(text.prefix_hash(raw), starts, ends)
    by_word = {}
    for s, e, h in zip(starts, ends, hashes.tolist()):
        assert by_word.setdefault(raw[s:e].tobytes(), h) == h
    assert len(set(by_word.values())) == len(by_word)


def test_windows_tell_order():
    one = np.array([1, 2, 3, 4, 5], np.uint64)
    assert len(set(text.windows(one, 3).tolist())) == 3
    assert text.windows(one, 3)[0] != text.windows(one[[1, 0, 2]], 3)[0]
    assert len(text.windows(one, 6)) == 0


def test_slices_keep_rows_whole():
    batch = pa.record_batch({"text": pa.array([b"a" * 3_000_000, b"b" * 9_000_000, None, b"c"], pa.binary())})
    got = [(rows.num_rows, len(raw)) for rows, raw, _ in text.slices(iter([batch]), "text")]
    assert sum(n for n, _ in got) == 4 and sum(b for _, b in got) == 12_000_001


@pytest.mark.parametrize("most", [1_500_000, 40])
def test_tokens_in_parts_are_those_of_the_whole_text(most):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    _, table, _ = packing._tokenizer(path)
    table = text.WordIds(table.encode, most)
    whole = Tokenizer.from_file(path)
    for seed in range(3):
        texts = _texts(seed)
        raw, off = _bytes(texts)
        low = text.lower_ascii(raw)
        starts, ends, first = text.words(low, off, packing._INSIDE, packing._CUT)
        flat, bounds = table.ids(low, starts, ends, text.range_hash(text.prefix_hash(low), starts, ends))
        for k, t in enumerate(texts):
            assert flat[bounds[first[k]] : bounds[first[k + 1]]].tolist() == whole.encode(t, add_special_tokens=False).ids
