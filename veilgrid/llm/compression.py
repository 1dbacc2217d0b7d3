"""Quality rules: bands of zstandard ratios over whole documents and fixed chunks.

Repetitive text compresses far better than prose, random text far worse. A text is rejected when the
ratio (compressed by raw bytes) of the whole, or that of more than a quarter of its fixed chunks, leaves
the band for its length. The text's last bytes are a full chunk too, so that every byte is in one. Short texts carry the frame's cost, so each length has limits of its own and texts
under the shortest limit are not judged by the ratio.

Null and empty texts have no words, fail the base rule, and have a null ratio. Repeated rows each get
a row. Whatever other columns the input has, they are not read by :func:`score` and kept by :func:`keep`.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

SPACE = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Bands:
    """``whole``: (least bytes, lowest ratio, highest ratio), by rising length; the last that fits counts.

    The highest lie between the highest ratio of clean prose and the lowest of random letters of that length: base64 from
    256 bytes on, a-z from 1024, hexadecimal from 3072. Below these lengths the two overlap, and prose is let pass.
    """

    level: int = 3
    chunk_bytes: int = 4096
    whole: tuple[tuple[int, float, float], ...] = (
        (128, 0.40, 1.05),
        (256, 0.40, 0.80),
        (384, 0.40, 0.78),
        (512, 0.38, 0.75),
        (768, 0.36, 0.70),
        (1024, 0.34, 0.608),
        (1536, 0.32, 0.59),
        (2048, 0.31, 0.575),
        (3072, 0.30, 0.521),
        (4096, 0.29, 0.52),
        (6144, 0.28, 0.50),
        (8192, 0.27, 0.49),
        (16384, 0.26, 0.475),
        (65536, 0.25, 0.475),
    )
    chunk: tuple[float, float] = (0.30, 0.521)
    bad_chunks: float = 0.25
    min_words: int = 50
    max_repeat_percent: int = 50


DEFAULT = Bands()
SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, ratio double, n_chunks long, n_bad_chunks long"
NAMES = [x.split()[0] for x in SCHEMA.split(", ")[1:]]


def repeat_words(words: list[bytes], width: int = 3) -> int:
    """Words that lie in a window of ``width`` words found twice or more, the first place included."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    windows = list(zip(*(words[k:] for k in range(width)), strict=False))
    if len(set(windows)) == n:
        return 0
    counts = Counter(windows)
    marks = bytearray(len(words))
    for i, x in enumerate(windows):
        if counts[x] > 1:
            marks[i : i + width] = b"\x01" * width
    return sum(marks)


def dup_lines(body: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in body.split(b"\n") if x.strip(SPACE)]
    return len(lines) - len(set(lines))


def judge(bands: Bands, body: bytes, compressor: zstandard.ZstdCompressor) -> tuple[bool, float | None, int, int]:
    """The method's verdict: inside the bands, the whole ratio, chunks and chunks outside their band."""
    n = len(body)
    if not n:
        return True, None, 0, 0
    ratio = len(compressor.compress(body)) / n
    limits = None
    for least, low, high in bands.whole:
        if n >= least:
            limits = (low, high)
    inside = limits is None or limits[0] <= ratio <= limits[1]
    step = bands.chunk_bytes
    chunks = -(-n // step) if n >= step else 0
    bad = 0
    if chunks:
        for i in [*range(0, n - step, step), n - step]:  # the last chunk ends with the text and may overlap the one before
            bad += not bands.chunk[0] <= len(compressor.compress(body[i : i + step])) / step <= bands.chunk[1]
        inside = inside and bad <= bands.bad_chunks * chunks
    return inside, ratio, chunks, bad


def measure(body: bytes, bands: Bands = DEFAULT, compressor: zstandard.ZstdCompressor | None = None) -> tuple:
    """All columns after ``doc_id`` for one text."""
    words = body.split()
    n = len(words)
    flat = b"".join(words)
    word_chars = len(flat) if flat.isascii() else len(flat.decode("utf-8", "replace"))
    n_repeat = repeat_words(words)
    base_failed = n < bands.min_words or 100 * n_repeat > bands.max_repeat_percent * n
    inside, ratio, chunks, bad = judge(bands, body, compressor or zstandard.ZstdCompressor(level=bands.level))
    return n, word_chars, len(body) - len(body.translate(None, SYMBOLS)), dup_lines(body), n_repeat, base_failed, inside and not base_failed, ratio, chunks, bad


class Measure:
    """:func:`measure` with one compressor for each worker."""

    def __init__(self, bands: Bands):
        self.bands, self.compressor = bands, None

    def __call__(self, body: bytes) -> tuple:
        if self.compressor is None:
            self.compressor = zstandard.ZstdCompressor(level=self.bands.level)
        return measure(body, self.bands, self.compressor)

    def __getstate__(self) -> dict:
        return {"bands": self.bands, "compressor": None}


def score(df: DataFrame, bands: Bands = DEFAULT) -> DataFrame:
    """A row of counts, ratios and the verdict for each document."""
    return common.per_document(common.text_rows(df), Measure(bands), SCHEMA, NAMES)


def keep(df: DataFrame, bands: Bands = DEFAULT) -> DataFrame:
    """The documents that pass, with all their columns; no shuffle: the verdict is a column beside them."""
    body = F.coalesce(F.col("text").cast("binary"), F.lit("").cast("binary"))
    judge_all = Measure(bands)
    verdict = NAMES.index("kept")

    @F.arrow_udf("boolean")
    def passes(column):
        import pyarrow as pa

        return pa.array([judge_all(x)[verdict] for x in column.to_pylist()], pa.bool_())

    return df.where(passes(body))
