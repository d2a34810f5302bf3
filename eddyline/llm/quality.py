"""Quality rules: repetition coverage of every text, measured with rolling hashes.

For several n-gram lengths and for lines, the characters inside duplicated stretches of the same text are counted, each
character once, and compared with limits on their share of the text. One pass over the texts without a shuffle; numpy
works on a few megabytes at a time, so memory follows the longest text only.

The limits have to add something to the base rule, which lets at most 20% of the words be in repeated 5-word windows. A word in
a repeated n-gram of 5 or more is in a repeated 5-gram too, so a limit near 20% could act only where repeated words are longer
than the average. The limits for n >= 5 therefore lie clearly below it and fall with n (0.15, 0.13, 0.10, the values of the
Gopher rules): the longer the repeated stretch, the less of it may come about by chance. A line's first copy is not counted, so a
pair of equal lines over 20% of a text has a share of 0.10; that is the limit for lines, which also sees lines of fewer than 5 words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from eddyline.llm.registry import query, table
from eddyline.llm.textbytes import Texts, groups, repeated, slices, windows

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
WINDOW = 5

# fixed values: n-gram length -> largest share of a text's characters in duplicated n-grams
MAX_SHARE = {2: 0.60, 3: 0.45, 5: 0.15, 7: 0.13, 10: 0.10}
MAX_LINE_SHARE = 0.10

SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, "
    + ", ".join(f"dup_{n}gram_share double" for n in MAX_SHARE)
    + ", dup_line_share double"
)


def covered(word_in: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """Marks the n words from each of `first`."""
    steps = np.bincount(first, minlength=len(word_in) + 1) - np.bincount(first + n, minlength=len(word_in) + 1)
    return np.cumsum(steps)[:-1] > 0


def measure(part: Texts) -> dict[str, np.ndarray]:
    """The columns of SCHEMA for each text of `part`."""
    n = part.n
    text, begin, end = part._words = part.word_bounds()
    at = part.characters()
    chars = at[end] - at[begin]
    per_text = lambda which, weight: np.bincount(which, weight, n).astype(np.int64)
    words = part.hashes(begin, end)
    out = {"n_words": np.bincount(text, minlength=n), "word_chars": per_text(text, chars)}
    before = np.zeros(len(part.data) + 1, np.int64)
    np.cumsum(SYMBOLS[part.data], out=before[1:])
    out["n_symbols"] = np.diff(before[part.starts])

    line_text, left, right = part.line_bounds()
    order, opens = groups(line_text, part.hashes(left, right))
    copies = order[~opens]
    out["n_dup_lines"] = np.bincount(line_text[copies], minlength=n)
    whole = np.maximum(np.diff(at[part.starts]), 1)
    shares = {"dup_line_share": per_text(line_text[copies], (at[right] - at[left])[copies]) / whole}
    good = shares["dup_line_share"] <= MAX_LINE_SHARE
    in_words = np.maximum(out["word_chars"], 1)
    for size in sorted({*MAX_SHARE, WINDOW}):
        first, h = windows(text, words, size)
        first = first[repeated(text[first], h)]
        hit = covered(text, first, size)
        if size == WINDOW:
            out["n_repeat_words"] = np.bincount(text[hit], minlength=n)
        if size in MAX_SHARE:
            share = shares[f"dup_{size}gram_share"] = per_text(text[hit], chars[hit]) / in_words
            good &= share <= MAX_SHARE[size]
    out["base_failed"] = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEATED_PERCENT * out["n_words"])
    out["kept"] = good & ~out["base_failed"]
    return out | shares


def rate(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `documents`: the key and the columns of SCHEMA.

    `n_repeat_words` counts words in 5-word windows found twice or more in the text; windows, words and lines are compared
    by 64-bit hashes within one text. A null or empty text has no words, fails the base rules and is not kept. Keys may be
    null or repeat; other columns are not read; an empty table gives no rows.
    """
    kind = dict(documents.dtypes)[key]
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(1)):
                found = measure(part)
                keys = batch.column(0).slice(part.first, part.n)
                yield pa.RecordBatch.from_arrays([keys, *(pa.array(found[c]) for c in names)], ["key", *names])

    return documents.select(key, text).mapInArrow(run, f"key {kind}, {SCHEMA}").withColumnRenamed("key", key)


@query("op6_quality_rules")
def op6_quality_rules(spark, sf_dir):
    """All documents under the repetition rules; see `rate`."""
    return rate(table(spark, sf_dir, "documents"))
