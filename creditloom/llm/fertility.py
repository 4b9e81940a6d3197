"""Quality rules: a base of word and line rules, then how well a public vocabulary fits the text.

``measure`` encodes every word of the whole text with a public vocabulary that falls back to bytes
and takes characters per token, letters per token, the share of byte tokens and the entropy of the
token distribution.  Letters per token tell prose from text that is full of marks: runs of marks are
characters as well, but take tokens without giving letters.
``judge`` rejects what lies outside the band of the text's language or, failing that, its script.
Text a vocabulary was not made for (broken encodings, random letters) breaks into short tokens or
bytes, and symbol noise into tokens without letters; text that repeats a few tokens has low entropy.  A text of n tokens has at
most log2(n) bits, so the least entropy is the band's or ENTROPY_SHARE of that, whichever is lower.

One pass, no shuffle, nothing kept between texts but a bounded table of encoded words.

Edge cases: a null or empty text, or one of white space, has no words, zero in every count, null
fertility, and fails the base; an unknown or null language takes its script's band; repeated rows
are judged alike; an empty table gives no rows; other columns ride along in ``row`` whatever they
are called.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.text import (
    BLANK_SEPARATED, WordIds, annotate, kept, per_text, prefix_hash, range_hash, windows, words,
)

# Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of the words
ENTROPY_SHARE = 0.7  # of log2(tokens): clean text of 50 words has 0.8 and more

#: Lead bytes of UTF-8 that stand for a script.
SCRIPTS = {
    "latin": [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC3, 0xCA)],
    "greek": [0xCE, 0xCF],
    "cyrillic": [*range(0xD0, 0xD4)],
    "semitic": [*range(0xD6, 0xDE)],
    "indic": [0xE0],
    "cjk": [*range(0xE3, 0xEE)],
}
_SCRIPT = np.full(256, len(SCRIPTS), np.uint8)
for _k, _bytes in enumerate(SCRIPTS.values()):
    _SCRIPT[_bytes] = _k

#: First bytes of letters; characters beyond ASCII count as such.
_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC2, 0x100)]] = True

#: (least characters per token, most, most byte tokens per cent, least entropy in bits of a long text, least letters per token); None: no bound.
Band = tuple[float | None, float | None, float | None, float | None, float | None]
SCRIPT_BANDS: dict[str, Band] = {
    "latin": (1.5, 8.0, 5.0, 3.5, 1.3),
    "greek": (0.7, 4.0, 60.0, 3.5, 0.6),
    "cyrillic": (0.9, 6.0, 30.0, 3.5, 0.8),
    "semitic": (0.5, 4.0, 60.0, 3.5, 0.4),
    "indic": (0.3, 3.0, 90.0, 3.0, 0.2),
    "cjk": (0.3, 3.0, 80.0, 3.5, 0.2),
    "other": (0.3, 12.0, 50.0, 3.5, None),
}
LANGUAGE_BANDS: dict[str, Band] = {
    "en": (1.7, 8.0, 2.0, 5.2, 1.4),
    "de": (1.7, 8.0, 3.0, 5.2, 1.4),
    "fr": (1.55, 8.0, 3.0, 5.2, 1.3),
    "es": (1.65, 8.0, 3.0, 5.2, 1.3),
}

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_tokens long, chars_per_token double, byte_share double, token_entropy double, script string, letters_per_token double"
)

def _vocabulary(path: str):
    """The vocabulary's table of words, and which of its ids are bytes."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    table = WordIds(lambda found: model.encode([w.decode("utf-8", "replace") for w in found], num_threads=1))
    return table, np.array([model.is_byte(i) for i in range(model.get_piece_size())])


def repeated_words(threes: np.ndarray) -> int:
    """Words inside three-word windows that occur twice or more."""
    ordered = np.sort(threes)
    if not (ordered[1:] == ordered[:-1]).any():
        return 0
    order = np.argsort(threes, kind="stable")
    twin = threes[order[1:]] == threes[order[:-1]]
    again = np.zeros(len(threes), bool)
    again[order[1:][twin]] = True
    again[order[:-1][twin]] = True
    inside = np.zeros(len(threes) + 2, bool)
    for k in range(3):
        inside[k : k + len(threes)] |= again
    return int(inside.sum())


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))


def entropy(ids: np.ndarray) -> float:
    """Bits per token of a text's own token distribution."""
    ordered = np.sort(ids)
    counts = np.diff(np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1], [True]])))
    share = counts / len(ids)
    return float(-(share * np.log2(share)).sum())


def measure(docs: DataFrame, vocabulary: str, keep: list[str] | None = None) -> DataFrame:
    """``row`` (the columns ``keep``, or all) and MEASURES for every row; ``vocabulary`` is a sentencepiece file."""
    symbols = np.zeros(256, bool)
    symbols[list(SYMBOLS)] = True
    names = np.array([*SCRIPTS, "other"], object)

    def run(rows: pa.RecordBatch, raw: np.ndarray, off: np.ndarray) -> list:
        table, is_byte = kept(("fertility", vocabulary), lambda: _vocabulary(vocabulary))
        starts, ends, first = words(raw, off, BLANK_SEPARATED)
        hashes = range_hash(prefix_hash(raw), starts, ends)
        threes = windows(hashes, 3)
        flat, bounds = table.ids(raw, starts, ends, hashes)
        tokens = bounds[first]
        n_words, n_tokens = np.diff(first), np.diff(tokens)
        chars = per_text(BLANK_SEPARATED[raw] & ((raw & 0xC0) != 0x80), off)
        kinds = _SCRIPT[raw]
        scripts = np.stack([per_text(kinds == k, off) for k in range(len(SCRIPTS))] + [np.zeros(len(off) - 1, np.int64)])
        scripts[-1] = scripts.max(axis=0) == 0
        data = raw.tobytes()
        some = n_tokens > 0
        at_least_one = np.maximum(n_tokens, 1)
        return [
            n_words,
            chars,
            per_text(symbols[raw], off),
            [duplicate_lines(data[s:e]) for s, e in zip(off[:-1].tolist(), off[1:].tolist())],
            [repeated_words(threes[s : e - 2]) if e - s > 3 else 0 for s, e in zip(first[:-1].tolist(), first[1:].tolist())],
            n_tokens,
            pa.array(chars / at_least_one, mask=~some),
            pa.array(per_text(is_byte[flat], tokens) / at_least_one, mask=~some),
            pa.array([entropy(flat[s:e]) if e > s else 0.0 for s, e in zip(tokens[:-1].tolist(), tokens[1:].tolist())], mask=~some),
            pa.array(names[scripts.argmax(axis=0)], pa.string()),
            pa.array(per_text(_LETTERS[raw], off) / at_least_one, mask=~some),
        ]

    return annotate(docs, run, MEASURES, keep)


def _within(band: Band) -> Column:
    least, most, byte_share, bits, letters = band
    per_token = F.col("chars_per_token")
    tests = [(least, per_token >= F.lit(least)), (most, per_token <= F.lit(most))]
    floor = F.least(F.lit(bits), ENTROPY_SHARE * F.log2("n_tokens"))
    tests += [(letters, F.col("letters_per_token") >= F.lit(letters))]
    tests += [(byte_share, 100 * F.col("byte_share") <= F.lit(byte_share)), (bits, F.col("token_entropy") >= floor)]
    inside = F.lit(True)
    for bound, test in tests:
        inside = inside & (F.coalesce(test, F.lit(False)) if bound is not None else F.lit(True))
    return inside


def judge(measured: DataFrame, lang: Column | None = None, languages: dict[str, Band] | None = None, scripts: dict[str, Band] | None = None) -> DataFrame:
    """``measured`` with base_failed and kept."""
    languages = LANGUAGE_BANDS if languages is None else languages
    scripts = SCRIPT_BANDS if scripts is None else scripts
    verdict = _within(scripts["other"])
    for name, band in scripts.items():
        verdict = F.when(F.col("script") == name, _within(band)).otherwise(verdict)
    if lang is not None:
        for name, band in languages.items():
            verdict = F.when(lang.eqNullSafe(name), _within(band)).otherwise(verdict)
    few = F.col("n_words") < LEAST_WORDS
    repeats = 100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    judged = measured.withColumn("base_failed", few | repeats)
    return judged.withColumn("kept", ~F.col("base_failed") & verdict)
