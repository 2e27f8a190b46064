"""Fill-in-middle: documents cut at two line ranks and put together in another order.

Each text's lines go into an indexable skip list: lane 0 has every line, a line is
in the next lane with probability 1/4 (by a hash of its number, so reruns agree),
and every step of a lane carries its width in lines and in code points. A cut rank
is reached from the top lane down by adding widths while they don't pass the rank;
the code points added up on the way are the cut, so no lane above is walked in full
and lines are never counted again for the second cut.

Ranks, order and the choice of plain documents come from a hash of the doc_id, so
copies of a row, retried tasks and reruns agree. ``restore`` gives the text back.

Null text counts as empty; empty texts, and texts with one of the markers, stay
plain. A null doc_id hashes as an empty number. Rows are independent: repeated
rows give a row each, an empty table gives none, other columns are never read. One
text at a time is in memory, however long; its lanes hold 4/3 numbers a line.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retention.llm.common import groups_of, ids_and_text, table, texts

#: Fixed values of the contract: markers, the hash's first part, percentages.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, FIM_PERCENT, SPM_PERCENT = "7:", 100, 50
#: Lines from which on there are express lanes, and bytes of text handled at a time.
FEW, BLOCK = 8, 4_000_000

SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


class SkipList:
    """Lines of the given code-point widths; ``seek(rank)`` is the code points before that line."""

    def __init__(self, points: list[int]):
        n = len(points)
        self.lanes = [([1] * n, points, [])]  # widths in lines, in code points; place of each node in the lane below
        at, widths = np.arange(n), np.array(points, np.int64)
        h = (at.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(31)
        while len(at) > FEW:
            up = (h & np.uint64(3)) == 0
            up[0] = True
            place = np.flatnonzero(up)
            at, h, widths = at[place], h[place] >> np.uint64(2), np.add.reduceat(widths, place)
            self.lanes.append((np.diff(np.append(at, n)).tolist(), widths.tolist(), place.tolist()))

    def seek(self, rank: int) -> int:
        i = lines = points = 0
        for units, widths, below in reversed(self.lanes):
            while i < len(units) and lines + units[i] <= rank:
                lines += units[i]
                points += widths[i]
                i += 1
            if lines == rank:
                break
            i = below[i] if below else i
        return points


def lines_of(text: str) -> list[int]:
    """Code points of each line, its line feed included."""
    lens = [len(x) + 1 for x in text.split("\n")]
    lens[-1] -= 1
    return lens if lens[-1] else lens[:-1]


def cut(doc_id: int | None, text: str, fim_percent: int, spm_percent: int, seed: str) -> tuple:
    """(lines, form, code points of prefix and of middle, output)."""
    digest = hashlib.sha256(f"{seed}{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
    lens = lines_of(text)
    n = len(lens)
    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or h3 % 100 >= fim_percent:
        return n, "plain", None, None, text
    lines = SkipList(lens)
    a, b = sorted((lines.seek(h1 % (n + 1)), lines.seek(h2 % (n + 1))))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm_percent:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def transform(docs: DataFrame, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT, seed: str = SEED) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row of ``docs`` (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, all_texts = b.column(0).to_pylist(), texts(b)
            for lo, hi in groups_of([len(t) for t in all_texts], BLOCK):
                rows = [cut(i, t.decode("utf-8"), fim_percent, spm_percent, seed) for i, t in zip(ids[lo:hi], all_texts[lo:hi])]
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([b.column(0)[lo:hi], *[pa.array(c, t) for c, t in zip(zip(*rows), kinds)]],
                                                 ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])
    return ids_and_text(docs).mapInArrow(run, SCHEMA)


def restore(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of: no part of it holds a marker, so they part it."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (F.when(form == "psm", F.concat(part[1], part[3], part[2]))
            .when(form == "spm", F.concat(part[2], part[3], part[1])).otherwise(output))


def query(spark, sf_dir: str) -> DataFrame:
    rows = transform(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


#: Fixed values of the contract, as above.
SQL = r"""
with d as (select doc_id, coalesce(text, '') text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') l,
                  sha256('7:' || coalesce(cast(doc_id as varchar), '')) h from documents),
c as (select doc_id, text, l, cast(len(l) as bigint) n, cast('0x' || h[1:8] as bigint) h1, cast('0x' || h[9:16] as bigint) h2,
             cast('0x' || h[17:24] as bigint) h3, cast('0x' || h[25:32] as bigint) h4 from d),
r as (select *, least(h1 % (n + 1), h2 % (n + 1)) a, greatest(h1 % (n + 1), h2 % (n + 1)) b,
             case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 100
                  then 'plain' when h4 % 100 < 50 then 'spm' else 'psm' end form from c),
p as (select *, array_to_string(l[1:a], '') prefix, array_to_string(l[a + 1:b], '') middle, array_to_string(l[b + 1:], '') suffix from r)
select doc_id, n, form, case when form <> 'plain' then length(prefix) end prefix_chars,
       case when form <> 'plain' then length(middle) end middle_chars,
       sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) output_sha256, sha256(text) restored_sha256
from p
"""
