"""Positions embedded in free text.

Texts are rows of a table, or files of any size read line by line (see
``positions_of_lines``).

Everything up to one row per position is map-only: a text is cut at its key
headers, so each piece carries its own key, and the positions of a piece come
from one regular expression. No token ever becomes a row of its own. The generators
are the outer kind: for the inner kind Spark infers a filter on the array's size
and would run the expressions twice.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from poseval.functions import position as P
from poseval.operators.positions import position_problems
from poseval.schema import require_columns
from poseval.session import stage

MAX_KEY = str(2**64 - 1)


def _at_most(limit: str) -> str:
    """Pattern of decimal numbers, leading zeros allowed, not above ``limit``."""
    shorter = f"[0-9]{{1,{len(limit) - 1}}}"
    below = [
        f"{limit[:i]}[0-{int(d) - 1}][0-9]{{{len(limit) - 1 - i}}}" for i, d in enumerate(limit) if d != "0"
    ]
    return f"0*(?:{'|'.join([shorter, *below, limit])})"


# The header word and the fields of a position in running text.
_KEY = r"\+?" + _at_most(MAX_KEY)
_HEADER = rf"(?<!\S)zobr64:\s+({_KEY})(?!\S)"
_RANK = "[PNBRQKpnbrqk1-8]{1,8}"
_POSITION = (
    rf"(?<!\S){_RANK}(?:/{_RANK}){{7}}"
    r"\s+[wb]"
    r"\s+(?:-|(?!\S*([KQkq])\S*\1)[KQkq]{1,4})"
    r"\s+(?:-|[a-h][1-8])"
    r"(?:\s+[0-9]+\s+[0-9]+)?(?!\S)"
)
HEADER = "(?U)" + _HEADER
NEXT_HEADER = rf"(?U)(?={_HEADER})"
POSITION = "(?U)" + _POSITION


def _positions(piece: Column) -> Column:
    """Positions of one text piece, single-spaced, in order."""
    found = F.transform(
        F.regexp_extract_all(piece, F.lit(POSITION), F.lit(0)),
        lambda m: F.regexp_replace(m, r"(?U)\s+", " "),
    )

    def valid(match: Column) -> Column:
        board = F.substring_index(match, " ", 1)
        return P.board_ok(board, P.expand_digits(board))

    return F.filter(found, valid)


def extract_positions(df: DataFrame, text: str = "text") -> DataFrame:
    """One row per position found in ``text``; other columns are kept.

    Adds ``zobr64`` (the last key header before it, or NULL), ``piece`` and
    ``nth`` (together the order inside the text) and ``fen``.
    """
    require_columns(df, [text])
    rest = [c for c in df.columns if c != text]
    pieces = df.select(*rest, F.posexplode_outer(F.split(F.col(text), NEXT_HEADER)).alias("piece", "_text"))
    found = pieces.select(*rest, "piece", "_text", F.posexplode_outer(_positions(F.col("_text"))).alias("nth", "fen"))
    header = F.regexp_extract("_text", HEADER, 1)
    key = F.when(header != "", F.regexp_replace(header, r"^\+?0*(?=[0-9])", "").cast("decimal(20,0)"))
    return found.where("fen IS NOT NULL").select(*rest, "piece", key.alias("zobr64"), "nth", "fen")


def group_positions(df: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Positions of each text grouped by key, groups in order of appearance.

    ``fens`` keeps order and copies. A list is never longer than the one text
    it came from. A missing key is a group of its own.
    """
    found = extract_positions(df.select(doc, text), text)
    groups = found.groupBy(doc, "zobr64").agg(
        F.min(F.struct("piece", "nth")).alias("first"),
        F.array_sort(F.collect_list(F.struct("piece", "nth", "fen"))).alias("items"),
    )
    order = Window.partitionBy(doc).orderBy("first")
    return groups.select(
        doc,
        (F.row_number().over(order) - 1).alias("group_no"),
        "zobr64",
        F.size("items").alias("n_fens"),
        F.transform("items", lambda i: i["fen"]).alias("fens"),
    )


def extraction_totals(df: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Positions and key groups per text."""
    found = extract_positions(df.select(doc, text), text)
    per_group = found.groupBy(doc, "zobr64").agg(F.count(F.lit(1)).alias("n"))
    return per_group.groupBy(doc).agg(F.sum("n").alias("fens"), F.count(F.lit(1)).alias("groups"))


def diagnose_text(df: DataFrame, text: str = "text") -> DataFrame:
    """Extracted positions with their problem lists."""
    return position_problems(extract_positions(df, text))


# --- files of lines ---------------------------------------------------------

# Tokens that a position may take after its board.
AHEAD = 5
# Characters of text that are searched at once.
CHUNK = 1 << 16
# Splits up to which their first tokens are sent to every task, some 100 bytes each.
MAX_BROADCAST_SPLITS = 500_000
# A token, by the same white space that the patterns use.
_TOKEN = re.compile("[^\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+")


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, list[str]]]:
    """Runs of lines of one split, as (file, block, lines)."""
    for b in batches:
        names, blocks, lines = (c.to_pylist() for c in b.columns)
        start = 0
        for i in range(1, b.num_rows + 1):
            if i == b.num_rows or names[i] != names[start] or blocks[i] != blocks[start]:
                yield names[start], blocks[start], lines[start:i]
                start = i


def _first_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Up to ``AHEAD`` tokens that each split begins with."""
    found: dict[tuple[str, int], list[str]] = {}
    for file, block, lines in _splits(batches):
        head = found.setdefault((file, block), [])
        for line in lines:
            if len(head) >= AHEAD:
                break
            head += [m[0] for m, _ in zip(_TOKEN.finditer(line), range(AHEAD - len(head)))]
    keys = list(found)
    yield pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64()), pa.array([" ".join(found[k]) for k in keys], pa.string())],
        names=["file", "block", "head"],
    )


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of about ``CHUNK`` characters, each with the tokens that follow it in its split.

    ``short`` says that the split ended before there were ``AHEAD`` of them.
    """
    split, number = None, 0
    waiting: list[list] = []  # text and tokens ahead of chunks that still lack some
    lines: list[str] = []
    size = 0

    def out(text: str, ahead: list[str], short: bool) -> pa.RecordBatch:
        nonlocal number
        number += 1
        cells = [[split[0]], [split[1]], [number], [text], [" ".join(ahead)], [short]]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds)], names=["file", "block", "chunk", "text", "ahead", "short"])

    def cut() -> Iterator[pa.RecordBatch]:
        """The open lines become a chunk; its first tokens are what earlier chunks wait for."""
        nonlocal lines, size
        text = "\n".join(lines)
        head = [m[0] for m, _ in zip(_TOKEN.finditer(text), range(AHEAD))]
        for w in waiting:
            w[1] += head[: AHEAD - len(w[1])]
        while waiting and len(waiting[0][1]) == AHEAD:
            yield out(*waiting.pop(0), False)
        waiting.append([text, []])
        lines, size = [], 0

    def end() -> Iterator[pa.RecordBatch]:
        nonlocal number
        if lines:
            yield from cut()
        while waiting:
            yield out(*waiting.pop(0), True)
        number = 0

    for file, block, some in _splits(batches):
        if (file, block) != split:
            yield from end()
            split = (file, block)
        for line in some:
            lines.append(line)
            size += len(line) + 1
            if size >= CHUNK:
                yield from cut()
    yield from end()


def positions_of_lines(lines: DataFrame) -> DataFrame:
    """Positions in files that are read as lines: ``file, block, chunk, nth, zobr64, fen``.

    ``lines`` is ``readers.read_text_lines``: each file is one text, cut into
    splits by Spark. A position or a key header may lie across lines and splits,
    and a header holds for all that follows it in its file. Each split first
    tells the few tokens it begins with, so that the one before can finish what
    it began; the last header of each chunk of text is then handed on over
    chunks and splits. ``block, chunk, nth`` is the order inside a file. No task
    holds more than a chunk of text and its longest line.
    """
    require_columns(lines, ["file", "block", "value"])
    rows = lines.select("file", "block", "value")
    heads = stage(rows.mapInArrow(_first_tokens, "file string, block long, head string"), "text-heads")
    heads = heads.groupBy("file", "block").agg(F.max("head").alias("head"))
    later = Window.partitionBy("file").orderBy("block").rowsBetween(1, AHEAD)
    following = heads.where("head <> ''").withColumn("next", F.array_join(F.collect_list("head").over(later), " "))
    # A split without tokens has no row; none of its chunks has anything to finish.
    following = stage(following.select("file", "block", "next"), "text-next")
    small = F.broadcast if following.count() <= MAX_BROADCAST_SPLITS else lambda d: d
    chunks = rows.mapInArrow(_chunks, "file string, block long, chunk long, text string, ahead string, short boolean")
    known = chunks.join(small(following), ["file", "block"], "left")
    ahead = F.when(F.col("short"), F.concat_ws(" ", "ahead", "next")).otherwise(F.col("ahead"))
    whole = known.select("file", "block", "chunk", ahead.alias("ahead"), F.concat_ws("\n", "text", ahead).alias("whole"))

    # What begins in the tokens ahead belongs to the next chunk. It comes last, and the tokens alone hold as much.
    def own(found: Column, beyond: Column) -> Column:
        return F.slice(found, F.lit(1), F.greatest(F.size(found) - F.size(beyond), F.lit(0)))

    pieces = F.split("whole", NEXT_HEADER)
    key = lambda p: F.nullif(F.regexp_extract(p, HEADER, 1), F.lit(""))
    found = F.flatten(F.transform(pieces, lambda p: F.transform(_positions(p), lambda f: F.struct(key(p).alias("key"), f.alias("fen")))))
    headers = F.regexp_extract_all("whole", F.lit(HEADER), F.lit(1))
    searched = whole.select(
        "file",
        "block",
        "chunk",
        own(found, _positions(F.col("ahead"))).alias("found"),
        own(headers, F.regexp_extract_all("ahead", F.lit(HEADER), F.lit(1))).alias("headers"),
    )
    searched = searched.select("file", "block", "chunk", "found", F.get("headers", F.size("headers") - 1).alias("last"))
    stored = stage(searched, "text-found")
    # Headers by chunk inside a split, then by split inside a file.
    earlier = Window.partitionBy("file", "block").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    inside = stored.withColumn("before", F.last("last", ignorenulls=True).over(earlier))
    ends = stored.where("last IS NOT NULL").groupBy("file", "block").agg(F.max_by("last", "chunk").alias("last"))
    every = stored.select("file", "block").distinct().join(ends, ["file", "block"], "left")
    above = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    handed = stage(every.select("file", "block", F.last("last", ignorenulls=True).over(above).alias("handed")), "text-handed")
    joined = inside.join(small(handed), ["file", "block"])
    rows = joined.select("file", "block", "chunk", F.coalesce("before", "handed").alias("before"), F.posexplode("found").alias("nth", "one"))
    text = F.coalesce("one.key", "before")
    number = F.regexp_replace(text, r"^\+?0*(?=[0-9])", "").cast("decimal(20,0)")
    return rows.select("file", "block", "chunk", "nth", number.alias("zobr64"), "one.fen")
