"""Conversation structure repair: a Viterbi search with survivor coalescence.

The roles of a conversation shall read `(s?(ua)+)?` by their initials. Every row is kept, gets the role user or assistant (Rerole), or is deleted; empty turns
of a user or an assistant are inserted anywhere. Blank and duplicate rows must be deleted; an undeleted truncated row costs extra. The cheapest edits win,
of equal ones those whose initials D, I, K, R come first in ASCII order.

The search keeps one survivor per state of the grammar (nothing yet, s, u, a). Survivors are leaves of a tree of backpointers with reference counts: a survivor that is
replaced gives its branch free, and once all survivors share an ancestor the edits up to it are final and leave the tree. Survivors that another one beats
whatever follows are dropped, so clean stretches coalesce at every row and a conversation is never held whole.

Ties are decided by the complete unresolved suffixes. Two survivors of one row never hold the same letters and neither's are the beginning of the other's (equal
letters mean the same state, and both end with an edit of that row); so the order of two longer suffixes is that of the survivors they go on from,
or of the new letters if that is the same one. The order of the survivors is carried from row to row, and no suffix is walked.

Rows are taken by turn, role and a digest of the text, nulls first; a null role or text counts as one space. A role without an initial, or with another one than
s, u or a, cannot be kept. Repeated rows are duplicates of the first. A null conv_id is a conversation; an empty table gives no rows.

First occurrences and repeats are told apart before rows meet (aggregates of texts and of counts, combined map-side): a repeated text travels once, its
repeats are narrow rows, one a turn. Then a conversation's rows pass through one task in order: its audit and digest are one value, made in that
order. Sorting spills, and only unresolved rows are held.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.llm.common import arrow_rows

COSTS = {"K": 0, "R": 3, "D": 4, "I": 3}
TRUNCATED_COST = 3
SPACES = " \t\n\v\f\r"
ENDS = (".", "!", "?")
NONE, S, U, A = range(4)  # states: what the roles read so far ends with
#: Spare cost with which a survivor can do whatever another one can: by inserts, or by deleting an s that the other one would keep.
_BEATS = {
    (NONE, U): 3, (NONE, A): 6, (NONE, S): 0, (S, U): 3, (S, A): 6, (S, NONE): 6, (U, A): 3, (U, S): 3, (U, NONE): 7, (A, U): 3, (A, S): 0, (A, NONE): 4,
}
FLUSH_ROWS, FLUSH_CHARS = 2_000, 2 << 20


def _asked(state: int) -> str:
    return "a" if state == U else "u"


def _after(role: str) -> int:
    return U if role == "u" else A


@lru_cache(maxsize=None)
def moves(initial: str, removed: bool, truncated: bool) -> list[tuple[int, int, int, str]]:
    """For a row of this kind: state before, state after, cost, and the letters of the inserts before it and of its edit."""
    out = [(state, state, COSTS["D"], "D") for state in (NONE, S, U, A)]
    more = TRUNCATED_COST if truncated else 0
    for state in () if removed else (NONE, S, U, A):
        at, inserts, seen = state, "", set()
        while at not in seen:
            seen.add(at)
            spent = COSTS["I"] * len(inserts) + more
            if at == NONE and initial == "s":
                out.append((state, S, spent, inserts + "K"))
            edit = "K" if initial == _asked(at) else "R"
            out.append((state, _after(_asked(at)), spent + COSTS[edit], inserts + edit))
            at, inserts = _after(_asked(at)), inserts + "I"
    return out


class Node:
    """Edits of one row; `refs` counts children, and the survivor that stands here."""

    __slots__ = ("parent", "letters", "refs", "children")

    def __init__(self, parent: Node | None, letters: str):
        self.parent, self.letters, self.refs, self.children = parent, letters, 0, set()


class Survivors:
    """The search over one conversation. `step` takes a row and returns the letters of the rows that are final now."""

    def __init__(self) -> None:
        self.root = Node(None, "")
        self.root.refs = 1
        self.best: dict[int, tuple[int, int, Node]] = {NONE: (0, 0, self.root)}  # state: cost, order of the complete suffix, leaf

    def step(self, initial: str, removed: bool = False, truncated: bool = False, times: int = 1) -> list[str]:
        """`times` equal rows that must be deleted count as one: deleting them all comes before any insert between them."""
        found: dict[int, tuple[int, int, str]] = {}
        source: dict[int, Node] = {}
        for before, after, cost, letters in moves(initial, removed, truncated):
            if before in self.best:
                spent, order, node = self.best[before]
                way = (spent + cost * times, order, letters)
                if after not in found or way < found[after]:
                    found[after], source[after] = way, node
        kept = [s for s in found if not any((t, s) in _BEATS and found[t][0] + _BEATS[t, s] < found[s][0] for t in found)]
        kept.sort(key=lambda s: found[s][1:])
        old = [node for _, _, node in self.best.values()]
        self.best = {}
        for order, state in enumerate(kept):
            node = Node(source[state], found[state][2])
            node.refs = 1
            node.parent.refs += 1
            node.parent.children.add(node)
            self.best[state] = (found[state][0], order, node)
        for node in old:
            self._release(node)
        return self._resolved()

    def _release(self, node: Node) -> None:
        node.refs -= 1
        while not node.refs and node is not self.root:
            parent = node.parent
            parent.children.discard(node)
            parent.refs -= 1
            node = parent

    def _resolved(self) -> list[str]:
        out = []
        while self.root.refs == 1 and self.root.children:
            self.root = self.root.children.pop()
            self.root.parent = None
            out.append(self.root.letters)
        return out

    def finish(self) -> tuple[list[str], int]:
        """Letters of the remaining rows, the last inserts in an entry of their own, and the whole cost."""
        inserts = {NONE: 0, S: 2, U: 1, A: 0}
        cost, _, state = min((cost + COSTS["I"] * inserts[s], order, s) for s, (cost, order, _) in self.best.items())
        out, node = [], self.best[state][2]
        while node is not self.root:
            out.append(node.letters)
            node = node.parent
        return [*reversed(out), "I" * inserts[state]], cost


def fault(text: str) -> str:
    """blank, truncated or nothing, of a text that was not seen before."""
    seen = text.rstrip(SPACES)
    return "blank" if not seen else "" if seen.endswith(ENDS) else "truncated"


_EDITS = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("place", T.LongType()),
        T.StructField("edit", T.StringType()),
        T.StructField("fault", T.StringType()),
        T.StructField("copies", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("old_role", T.StringType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)
_EDITS_ARROW = pa.schema(
    [("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("fault", pa.string()), ("copies", pa.int64()), ("turn", pa.int64()), ("old_role", pa.string()), ("role", pa.string()), ("text", pa.string())]
)


def _conversation(conv_id: int | None, rows: Iterator[tuple]) -> Iterator[tuple]:
    """Edits of one conversation, from its rows (turn, role, text or null, copies or null) in order; a row that only names it has no role."""
    search, waiting, state, place = Survivors(), deque(), NONE, -1
    yield (conv_id, None, None, None, 0, None, None, None, None)  # so that a conversation without rows is seen

    def told(resolved: list[str]) -> Iterator[tuple]:
        nonlocal state, place
        for letters in resolved:
            for letter in letters:
                if letter == "D":
                    kind, copies, turn, role, _ = waiting.popleft()
                    yield conv_id, None, "D", kind, copies, turn, role, None, None
                    continue
                place += 1
                named = {"u": "user", "a": "assistant"}[_asked(state)]
                if letter == "I":
                    state = _after(_asked(state))
                    yield conv_id, place, "I", "", 1, None, None, named, ""
                    continue
                kind, copies, turn, role, text = waiting.popleft()
                state = S if letter == "K" and state == NONE and role.startswith("s") else _after(_asked(state))
                yield conv_id, place, letter, kind, copies, turn, role, role if letter == "K" else named, text

    def taken(kind: str, copies: int, turn: int | None, role: str, text: str | None) -> Iterator[tuple]:
        waiting.append((kind, copies, turn, role, text if kind in ("", "truncated") else None))
        yield from told(search.step(role[:1], kind in ("blank", "duplicate"), kind == "truncated", copies))

    first = None
    for turn, role, text, copies in rows:
        if role is None:
            continue
        if copies is None:  # the first row with this role and text; its count follows
            first = (turn, role)
            yield from taken(fault(text), 1, turn, role, text)
            continue
        # blank comes before duplicate, and only the first row of a text shows that it is blank: `text` is then true
        again = copies - 1 if first == (turn, role) else copies
        first = None
        if again:
            yield from taken("blank" if text else "duplicate", again, turn, role, None)
    yield from told(search.finish()[0])


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = _Ahead(arrow_rows(batches, ["conv_id", "turn", "role", "text", "copies"]))
    ready, size = [], 0
    while rows.more():
        for edit in _conversation(rows.head[0], rows.group()):
            ready.append(edit)
            size += len(edit[-1] or "")
            if len(ready) >= FLUSH_ROWS or size >= FLUSH_CHARS:
                yield _batch(ready, _EDITS_ARROW)
                ready, size = [], 0
    if ready:
        yield _batch(ready, _EDITS_ARROW)


class _Ahead:
    """Sorted rows, one group of equal first values after the other."""

    def __init__(self, rows: Iterator[tuple]):
        self.rows = rows
        self.head: tuple | None = next(rows, None)

    def more(self) -> bool:
        return self.head is not None

    def group(self) -> Iterator[tuple]:
        key = self.head[0]
        while self.head is not None and self.head[0] == key:
            row, self.head = self.head, next(self.rows, None)
            yield row[1:]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)


def edits(turns: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """The edits of every conversation in their order: conv_id, place (from 0, of rows that stay), edit, fault, copies (of deleted rows in a run), turn, old_role, role, text.

    Each conversation begins with a row without edit, also those that only `conversations` (conv_id) names. Rows of a conversation follow one another in
    one partition, so that the next operator can go on with them as a stream.
    """
    space = F.lit(" ")
    own = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), space).alias("role"), F.coalesce(F.col("text"), space).alias("text"),
    )
    at = F.struct("turn")  # a null turn is the smallest in a struct
    texts = own.groupBy("conv_id", "role", "text").agg(F.min(at)["turn"].alias("turn"))
    firsts = texts.select("conv_id", F.lit(1).alias("kind"), "turn", "role", F.md5("text").alias("digest"), F.lit(0).alias("nth"), "text", F.lit(None).cast("long").alias("copies"))
    blank = F.when(F.length(F.translate("text", SPACES, "")) == 0, "blank")
    counts = own.groupBy("conv_id", "turn", "role", F.md5("text").alias("digest"), blank.alias("text")).agg(F.count(F.lit(1)).alias("copies"))
    repeats = counts.select("conv_id", F.lit(1).alias("kind"), "turn", "role", "digest", F.lit(1).alias("nth"), "text", "copies")
    parts = firsts.unionByName(repeats)
    if conversations is not None:
        none = [F.lit(None).cast("string").alias(x) for x in ("role", "digest")]
        names = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
        parts = parts.unionByName(
            names.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), *none, F.lit(0).alias("nth"), F.lit(None).cast("string").alias("text"), F.lit(None).cast("long").alias("copies"))
        )
    met = parts.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "digest", "nth")
    return met.select("conv_id", "turn", "role", "text", "copies").mapInArrow(_edits, _EDITS)


def repaired(turns: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), role, text, and the turn it came from (null: inserted)."""
    return edits(turns).filter("place IS NOT NULL").select("conv_id", "place", "role", "text", "turn")


LEGAL = ("su", "ua", "au")
_SUMMARY = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        *[T.StructField(n, T.LongType()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        T.StructField("audit", T.StringType()),
        T.StructField("repaired_sha256", T.StringType()),
    ]
)
_SUMMARY_ARROW = pa.schema(
    [("conv_id", pa.int64()), *[(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string()), ("repaired_sha256", pa.string())]
)


class _Summary:
    def __init__(self, conv_id: int | None):
        self.conv_id, self.illegal, self.cost, self.letters = conv_id, 0, 0, []
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.low = self.high = self.before = None
        self.turns = 0
        self.hash, self.begun = hashlib.sha256(), False

    def add(self, edit: str, fault: str, copies: int, turn: int | None, old_role: str | None, role: str | None, text: str | None) -> None:
        self.letters.append(edit * copies)
        self.cost += copies * COSTS[edit]
        if fault:
            self.faults[fault] += copies
            self.cost += TRUNCATED_COST if fault == "truncated" and edit != "D" else 0
        if edit != "I":
            if turn is not None and turn != self.high:  # rows come by turn
                self.low = turn if self.low is None else self.low
                self.high, self.turns = turn, self.turns + 1
            pair = None if self.before is None else self.before + old_role[:1]
            self.illegal += (pair is not None and pair not in LEGAL) + copies - 1
            self.before = old_role[:1]
        if edit != "D":
            self.hash.update((f"\n{role}:{text}" if self.begun else f"{role}:{text}").encode())
            self.begun = True

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return self.conv_id, min(gaps, (1 << 63) - 1), *self.faults.values(), self.illegal, self.cost, "".join(self.letters), self.hash.hexdigest()


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, ready, size = None, [], 0
    for conv_id, *edit in arrow_rows(batches, ["conv_id", "edit", "fault", "copies", "turn", "old_role", "role", "text"]):
        if edit[0] is not None:
            now.add(*edit)
            continue
        if now is not None:
            ready.append(now.row())
            size += len(ready[-1][-2])
            if len(ready) >= FLUSH_ROWS or size >= FLUSH_CHARS:
                yield _batch(ready, _SUMMARY_ARROW)
                ready, size = [], 0
        now = _Summary(conv_id)
    if now is not None:
        yield _batch([*ready, now.row()], _SUMMARY_ARROW)


def audited(found: DataFrame) -> DataFrame:
    """One row per conversation of `edits`: counts of faults, cost, the edits' initials, and a digest of the repaired rows."""
    return found.mapInArrow(_summaries, _SUMMARY)


def damaged(turns: DataFrame) -> DataFrame:
    """Rows with faults made from their ids, for tests and measurements of the repair."""
    space = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(x).cast("string"), space) for x in ("conv_id", "turn")])
    code = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    text = F.when(code == 1, "").when(code == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    return turns.filter(code != 0).select(
        "conv_id", "turn", F.when(code == 4, "user").otherwise(role).alias("role"), text.alias("text"),
        F.explode(F.array_repeat(F.lit(1), F.when(code == 3, 2).otherwise(1))).alias("nth"),
    ).drop("nth")
