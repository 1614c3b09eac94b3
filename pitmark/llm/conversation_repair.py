"""Repair of the turn structure of conversations by iterative-deepening A*."""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

_WHITE = " \t\n\x0b\x0c\r"
#: Kinds of roles by initial, and of faults.
_SYSTEM, _USER, _ASSISTANT, _OTHER = range(4)
_SOUND, _TRUNCATED, _BLANK, _DUPLICATE = range(4)
#: A row that has gone: it only says that its conversation exists.
_GONE = 16
_DELETE, _ROLE, _INSERT, _CUT_OFF = 4, 3, 3, 3
#: States: nothing yet, after s, after u, after a. What an inserted or renamed row leads to.
_NEXT = (2, 2, 3, 2)
_KEEPS = {(0, _SYSTEM): 1, (0, _USER): 2, (1, _USER): 2, (3, _USER): 2, (2, _ASSISTANT): 3}
#: Rows between those whose states are searched first.
_STRETCH = 16
_NUMBERS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _edges(code: int) -> list[list[tuple[str, int, int, int]]]:
    """For each state the edits at a row, in ASCII order: letter, cost, rows passed, next state."""
    role, fault = divmod(code, 4)
    extra = _CUT_OFF if fault == _TRUNCATED else 0
    found = []
    for state in range(4):
        some = [("D", _DELETE, 1, state), ("I", _INSERT, 0, _NEXT[state])]
        if fault < _BLANK:
            if (state, role) in _KEEPS:
                some.append(("K", extra, 1, _KEEPS[state, role]))
            some.append(("R", _ROLE + extra, 1, _NEXT[state]))
        found.append(some)
    return found


_EDGES = [_edges(code) for code in range(16)]
_AT_END = [[("I", _INSERT, 0, _NEXT[state])] for state in range(4)]


def _bound(codes: bytes, least: array, first: int, goal: int) -> None:
    """Put in the table what is left to pay at least at rows ``first`` to ``goal``, by state, at 4 * row + state; row ``goal`` is exact.

    Blank and duplicate rows cost a deletion and truncated ones 3 at least,
    whatever else happens. Of the other rows, neighbours that may not stand next
    to each other need an edit that touches one of them, which costs 3 or, where
    it may be the deletion of a truncated row, 1 more; so does a last row of all
    that is no assistant's. Pairs without a common row add up: the best choice
    of such pairs is taken. The states of row ``goal`` add what the least of them takes.
    """
    last = goal == len(codes)
    forced, here, after = 0 if last else min(least[4 * goal : 4 * goal + 4]), 0, 0  # bounds of pairs from the next of the other rows on, and from the one after it
    following, weight_of_following = None, 0
    for i in range(goal - 1, first - 1, -1):
        role, fault = divmod(codes[i], 4)
        if fault >= _BLANK:
            forced += _DELETE
        else:
            weight = 1 if fault == _TRUNCATED else 3
            forced += _CUT_OFF if fault == _TRUNCATED else 0
            if following is None:
                pair = weight if last and role != _ASSISTANT else 0
            else:
                pair = 0 if (role + 1, following) in _KEEPS and role < _OTHER else min(weight, weight_of_following)
            here, after = max(here, pair + after), here
            following, weight_of_following = role, weight
        for state in range(4):
            if following is None:
                rest = least[4 * goal + state] if last else 0
            elif (state, following) in _KEEPS:
                rest = here
            else:
                rest = max(here, weight_of_following + after)
            least[4 * i + state] = forced + rest


def _deepen(codes: bytes, least: array, start: int, goal: int) -> str | None:
    """Search from a place in the table under bounds that rise until a path ends well; its letters, or None where it ends at row ``goal``.

    ``least`` is the table of failed states: one whose search has failed keeps
    what it would take at least, and isn't searched again with less. Entries of
    row ``goal`` are exact; then the entry of ``start`` is so too.
    """
    n = len(codes)
    following = lambda row, state: _EDGES[codes[row]][state] if row < n else _AT_END[state]
    while True:
        # open states: place in the table, money left, edits, next edit to try, least money that a failed edit would take
        path: list[list] = [[start, least[start], following(start // 4, start % 4), 0, 1 << 30]]
        while path:
            top = path[-1]
            at, left, edits, k, needed = top
            if at >= 4 * goal and (goal < n or at - 4 * n in (0, 3)):
                return None if goal < n else "".join(x[2][x[3] - 1][0] for x in path[:-1])
            if k == len(edits):
                least[at] = max(least[at], needed)
                path.pop()
                if path:  # the edit that led here takes so much
                    over = path[-1]
                    over[4] = min(over[4], least[at] + over[2][over[3] - 1][1])
                continue
            top[3] = k + 1
            _, cost, passed, state = edits[k]
            row = at // 4 + passed
            place = 4 * row + state
            if least[place] + cost > left:
                top[4] = min(needed, least[place] + cost)
            else:
                path.append([place, left - cost, following(row, state), 0, 1 << 30])


def cheapest_edits(codes: bytes) -> tuple[int, str]:
    """The least cost and, of the cheapest edits, the ASCII-least letters that make the role initials ``(s?(ua)+)?``.

    Depth-first search takes edits in ASCII order under a bound on the cost that
    starts at a lower bound and rises to the least that any failed path would
    take; the first path that ends well under the first bound that allows one is
    the answer. So that bounds rise where the trouble is and not all over again
    from the start, the states of every 16th row are searched first, from the
    last on, each up to the next such row: time grows with the rows.
    """
    n = len(codes)
    least = array("i", bytes(16 * (n + 1)))
    least[4 * n + 1], least[4 * n + 2] = 2 * _INSERT, _INSERT
    goal = n
    for row in range((n - 1) // _STRETCH * _STRETCH, -1, -_STRETCH):
        _bound(codes, least, row, goal)
        for state in range(4 if row else 0):
            _deepen(codes, least, 4 * row + state, goal)
        goal = row
    audit = _deepen(codes, least, 0, n)
    return least[0], audit


def _faults(rows: DataFrame, conv: str, turn: str, role: str, text: str, gone: Column | None) -> DataFrame:
    """conv_id, turn, role, text, digest, gone, and code without duplicates: role times 4 and fault. Null roles and texts are one space."""
    rows = rows.select(
        rows[conv].alias("conv_id"), rows[turn].alias("turn"), F.coalesce(rows[role].cast("string"), F.lit(" ")).alias("role"), F.coalesce(rows[text].cast("string"), F.lit(" ")).alias("text"),
        (F.lit(False) if gone is None else F.coalesce(gone, F.lit(False))).alias("gone"),
    )
    end = F.rtrim("text", F.lit(_WHITE))
    fault = F.when(end == "", _BLANK).when(F.right(end, F.lit(1)).isin(".", "!", "?"), _SOUND).otherwise(_TRUNCATED)
    initial = F.left("role", F.lit(1))
    kind = F.when(initial == "s", _SYSTEM).when(initial == "u", _USER).when(initial == "a", _ASSISTANT).otherwise(_OTHER)
    return rows.withColumns({"digest": F.sha2("text", 256), "code": kind * 4 + fault})


_ORDER = ["turn", "role", "digest"]


def _streams(batches: Iterator[pa.RecordBatch], start: Callable, each: Callable, end: Callable, schema: pa.Schema, rows_out: int = 1000) -> Iterator[pa.RecordBatch]:
    """Fold rows that come conversation by conversation, the id first: ``end(each(start(id), row) ...)`` gives rows of ``schema``."""
    nothing = object()
    key, state, out = nothing, None, []
    for b in batches:
        for row in zip(*[c.to_pylist() for c in b.columns], strict=True):
            if row[0] != key:
                if key is not nothing:
                    out += end(state)
                key, state = row[0], start(row[0])
            out += each(state, row)
            if len(out) >= rows_out:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
    if key is not nothing:
        out += end(state)
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def _audits(faults: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit of each conversation."""
    kind = faults.schema["conv_id"].dataType
    schema = pa.schema([("conv_id", to_arrow_type(kind)), *[(c, pa.int64()) for c in _NUMBERS], ("audit", pa.string())])
    seen = F.row_number().over(Window.partitionBy("conv_id", "gone", "role", "digest").orderBy("turn")) > 1
    code = F.when(F.col("gone"), _GONE).when(seen & (F.col("code") % 4 != _BLANK), F.col("code") - F.col("code") % 4 + _DUPLICATE).otherwise(F.col("code"))
    light = faults.select("conv_id", "turn", "role", "digest", code.alias("code"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def start(conv):
            return {"conv": conv, "codes": bytearray(), "first": None, "last": None, "turns": 0}

        def each(c, row):
            _, turn, _, _, code = row
            if code != _GONE:
                c["codes"].append(code)
                if turn is not None and turn != c["last"]:
                    c["first"], c["last"], c["turns"] = turn if c["first"] is None else c["first"], turn, c["turns"] + 1
            return []

        def end(c):
            codes = bytes(c["codes"])
            cost, audit = cheapest_edits(codes)
            a = np.frombuffer(codes, np.uint8)
            fault, role = a & 3, a >> 2
            legal = (role[:-1] == _SYSTEM) & (role[1:] == _USER) | (role[:-1] == _USER) & (role[1:] == _ASSISTANT) | (role[:-1] == _ASSISTANT) & (role[1:] == _USER)
            gaps = 0 if c["first"] is None else int(c["last"]) - int(c["first"]) + 1 - c["turns"]
            counts = [int((fault == k).sum()) for k in (_BLANK, _DUPLICATE, _TRUNCATED)]
            return [dict(zip(schema.names, (c["conv"], gaps, *counts, int((~legal).sum()), cost, audit), strict=True))]

        return _streams(batches, start, each, end, schema)

    ordered = light.repartition("conv_id").sortWithinPartitions("conv_id", *_ORDER)
    return ordered.mapInArrow(run, T.StructType([faults.schema["conv_id"], *[T.StructField(c, T.LongType()) for c in _NUMBERS], T.StructField("audit", T.StringType())]))


def _repaired(faults: DataFrame, digests: bool) -> DataFrame:
    """The rows after the edits, or their digest beside the audit.

    Each conversation's audit comes first, then its rows in order: they are
    edited as they pass by, and only the audit is held.
    """
    kind = faults.schema["conv_id"].dataType
    audits = _audits(faults).withColumn("follows", F.lit(False))
    rows = faults.where("not gone").select("conv_id", "turn", "role", "digest", "text", F.lit(True).alias("follows"))
    both = audits.unionByName(rows, allowMissingColumns=True).repartition("conv_id").sortWithinPartitions("conv_id", "follows", *_ORDER)
    both = both.select("conv_id", "follows", "role", "text", "audit", *_NUMBERS)
    if digests:
        fields = [*[(c, T.LongType()) for c in _NUMBERS], ("audit", T.StringType()), ("repaired_sha256", T.StringType())]
    else:
        fields = [("place", T.LongType()), ("role", T.StringType()), ("text", T.StringType())]
    schema = pa.schema([("conv_id", to_arrow_type(kind)), *[(c, to_arrow_type(k)) for c, k in fields]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def start(conv):
            return {"conv": conv, "at": 0, "state": 0, "n": 0, "hash": hashlib.sha256()}

        def put(c, role, text):
            c["state"], k, c["n"] = {"s": 1, "u": 2, "a": 3}[role[0]], c["n"], c["n"] + 1
            if not digests:
                return [dict(zip(schema.names, (c["conv"], k, role, text), strict=True))]
            c["hash"].update(("\n" * (k > 0) + f"{role}:{text}").encode("utf-8", "surrogatepass"))
            return []

        def new(c):
            return "user" if _NEXT[c["state"]] == 2 else "assistant"

        def inserted(c):
            out = []
            while c["at"] < len(c["audit"]) and c["audit"][c["at"]] == "I":
                c["at"] += 1
                out += put(c, new(c), "")
            return out

        def each(c, row):
            _, follows, role, text, audit, *numbers = row
            if not follows:
                c["audit"], c["numbers"] = audit, numbers
                return []
            out = inserted(c)
            edit = c["audit"][c["at"]]
            c["at"] += 1
            return out if edit == "D" else out + put(c, role if edit == "K" else new(c), text)

        def end(c):
            out = inserted(c)
            return [dict(zip(schema.names, (c["conv"], *c["numbers"], c["audit"], c["hash"].hexdigest()), strict=True))] if digests else out

        return _streams(batches, start, each, end, schema)

    return both.mapInArrow(run, T.StructType([faults.schema["conv_id"], *[T.StructField(c, k) for c, k in fields]]))


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", gone: Column | None = None) -> DataFrame:
    """The rows of all conversations after the cheapest edits: conv_id, place (from 0), role, text.

    Rows stand by turn (null first), then role, then digest of the text. A row
    without anything but white space is blank, one whose role and text the
    conversation had before is a duplicate, and one whose last character that is
    no white space isn't one of ``.!?`` is truncated; the first that holds
    counts. Keeping costs nothing, another role 3, deleting 4 (blank and
    duplicate rows must go), an empty row of user or assistant 3, and each
    truncated row that stays 3 more. The edits make the initials of the roles
    ``(s?(ua)+)?``; ``cheapest_edits`` says which of the cheapest are taken.

    Null roles and texts are one space; null ids make one conversation, and null
    turns come first. Rows marked ``gone`` aren't there, but their conversation
    is. Rows that are wholly alike are duplicates in any order. An empty table
    gives no rows; other columns are ignored. A task holds one byte for each
    row of a conversation while it searches and the audit while rows pass by;
    their texts pass in batches.
    """
    return _repaired(_faults(rows, conv_col, turn_col, role_col, text_col, gone), False)


def repair_report(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", gone: Column | None = None) -> DataFrame:
    """For each conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256; rows as in ``repair``.

    ``gaps`` are turns between the first and the last that no row has;
    ``illegal`` counts neighbouring role initials other than su, ua and au, both
    before the repair. A conversation whose rows have all gone has zeros, an
    empty audit and the digest of nothing.
    """
    return _repaired(_faults(rows, conv_col, turn_col, role_col, text_col, gone), True)
