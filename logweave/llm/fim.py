"""Fill-in-middle transformation over a sparse exception index.

A text is cut at two units (lines or code points) into prefix, middle and suffix, and
these are written in an order that a model can be trained on: ``psm`` (prefix, suffix,
middle) or ``spm`` (suffix, prefix, middle), each part behind its marker.

Texts stay UTF-8 bytes.  Of a batch only the multibyte characters are recorded: the
place of each and how many bytes it has beyond one.  A code point's byte is its number
plus the excess of the multibyte characters before it, and a byte's code point the byte
less that excess; both come from one ``searchsorted`` in the index, and where no
character is multibyte they are plain arithmetic.

The draws come from the hex SHA-256 of ``salt:id``, so that every run gives the same
output: h1 and h2 choose the cuts, h3 whether the text is transformed, h4 the form.

Defined cases: a null or empty text and one that holds a marker stay plain; a null id is
drawn as an empty one; repeated rows give equal rows; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import small_batches

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SALT = "7"
#: Of 100 texts so many are transformed, and of those so many into spm.
FIM_PERCENT = 100
SPM_PERCENT = 50
UNITS = ("line", "char")


class MultibyteIndex:
    """Multibyte characters of concatenated UTF-8 texts: ``at``, the byte where each
    starts, and ``excess``, the bytes beyond one per character of all up to it."""

    def __init__(self, data: np.ndarray) -> None:
        self.at = np.flatnonzero(data >= 0xC0)
        lead = data[self.at]
        more = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.excess = np.r_[0, np.cumsum(more)]
        #: Number of the code point that each multibyte character is.
        self.point = self.at - self.excess[:-1]

    def points(self, byte: np.ndarray) -> np.ndarray:
        """Code points before each byte that starts a character (or ends the data)."""
        return byte - self.excess[np.searchsorted(self.at, byte)]

    def bytes(self, point: np.ndarray) -> np.ndarray:
        """The byte at which each code point starts."""
        return point + self.excess[np.searchsorted(self.point, point)]


def line_ends(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of concatenated texts that start at ``starts`` (the end of the data last): the
    bytes after every line, and how many of them come before each text's start.  A
    line runs up to its newline, the last one of a text to the text's end."""
    stops = np.flatnonzero(data == 0x0A) + 1
    ends = starts[1:][starts[1:] > starts[:-1]]         # of texts that are not empty
    stops = np.union1d(stops, ends)
    return stops, np.searchsorted(stops, starts, side="right")


def cut_points(data: np.ndarray, starts: np.ndarray, h1: np.ndarray, h2: np.ndarray,
               unit: str = "line") -> tuple[np.ndarray, ...]:
    """(n units, byte and code point where the prefix ends, where the middle ends) of
    each text; bytes and code points are counted from the text's start."""
    index = MultibyteIndex(data)
    first = index.points(starts)
    if unit == "line":
        stops, before = line_ends(data, starts)
        n = np.diff(before)
    else:
        n = np.diff(first)
    a, b = h1 % (n + 1), h2 % (n + 1)
    units = np.minimum(a, b), np.maximum(a, b)
    out = [n]
    for u in units:
        if unit == "line":
            # the u-th line end of the text; its start for u = 0
            at = np.where(u > 0, np.r_[stops, 0][np.where(u > 0, before[:-1] + u - 1, -1)], starts[:-1])
            point = index.points(at)
        else:
            point = first[:-1] + u
            at = index.bytes(point)
        out += [at - starts[:-1], point - first[:-1]]
    return tuple(out)


def render(text: bytes, cut: int, end: int, form: str) -> bytes:
    """The text with text[cut:end] as its middle, in the given form."""
    if form == "plain":
        return text
    prefix, middle, suffix = text[:cut], text[cut:end], text[end:]
    if form == "psm":
        return b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))
    return b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))


def restore(output: bytes, form: str) -> bytes:
    """The text that ``render`` made the output of.  No part holds a marker, so the
    first of each is the real one."""
    if form == "plain":
        return output
    one, two = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    if not output.startswith(one):
        raise ValueError(f"no {form} output")
    second = output.index(two, len(one))
    third = output.index(MIDDLE, second + len(two))
    x, y = output[len(one):second], output[second + len(two):third]
    middle = output[third + len(MIDDLE):]
    return x + middle + y if form == "psm" else y + middle + x


def draws(salt: str, id_col: str) -> list:
    """Columns h1 to h4: the first four groups of eight hex digits."""
    key = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
                 .cast("binary"), 256)
    return [F.conv(F.substring(key, 8 * k + 1, 8), 16, 10).cast("bigint").alias(f"h{k + 1}")
            for k in range(4)]


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   unit: str = "line", salt: str = SALT, fim_percent: int = FIM_PERCENT,
                   spm_percent: int = SPM_PERCENT, with_output: bool = True) -> DataFrame:
    """id, n (units), form (plain, psm or spm), prefix_chars, middle_chars (code points,
    null if plain), output_sha256, restored_sha256 (of the text rebuilt from output and
    form) and, if asked for, the output."""
    if unit not in UNITS:
        raise ValueError(f"unit {unit!r} is none of {UNITS}")
    small_batches(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
            whole = texts.buffers()[2]
            data = np.frombuffer(whole, np.uint8)[at[0]:at[-1]] if whole is not None \
                else np.zeros(0, np.uint8)
            h1, h2, h3, h4 = [batch.column(i).to_numpy() for i in range(2, 6)]
            starts = at - at[0]
            n, cut, cut_point, end, end_point = cut_points(data, starts, h1, h2, unit)
            forms, outputs, sums, back, prefix, middle = [], [], [], [], [], []
            for i, text in enumerate(texts.to_pylist()):
                plain = not text or PREFIX in text or SUFFIX in text or MIDDLE in text \
                    or h3[i] % 100 >= fim_percent
                form = "plain" if plain else "spm" if h4[i] % 100 < spm_percent else "psm"
                output = render(text, int(cut[i]), int(end[i]), form)
                forms.append(form)
                sums.append(hashlib.sha256(output).hexdigest())
                back.append(hashlib.sha256(restore(output, form)).hexdigest())
                prefix.append(None if plain else int(cut_point[i]))
                middle.append(None if plain else int(end_point[i] - cut_point[i]))
                if with_output:
                    outputs.append(output)
            cols = {"id": batch.column(0), "n": pa.array(n, pa.int64()), "form": pa.array(forms, pa.string()),
                    "prefix_chars": pa.array(prefix, pa.int64()), "middle_chars": pa.array(middle, pa.int64()),
                    "output_sha256": pa.array(sums, pa.string()), "restored_sha256": pa.array(back, pa.string())}
            if with_output:
                cols["output"] = pa.array(outputs, pa.binary())
            yield pa.RecordBatch.from_pydict(cols)

    schema = (f"id {id_type}, n long, form string, prefix_chars long, middle_chars long, "
              "output_sha256 string, restored_sha256 string") + (", output binary" if with_output else "")
    out = docs.select(F.col(id_col).alias("id"),
                      F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
                      *draws(salt, id_col)).mapInArrow(run, schema)
    if with_output:
        out = out.withColumn("output", F.col("output").cast("string"))
    return out.withColumnRenamed("id", id_col)
