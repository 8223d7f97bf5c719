"""Conversation structure repair by iterative-deepening A*.

A sound conversation has the role initials `(s?(ua)+)?`. Edits are Delete, Insert, Keep and Rerole; a depth-first search
tries them in ASCII order under a bound on the cost, which rises to the least cost that went beyond it until a path is
accepted. As the bound never passes the least cost, the first accepted path is the cheapest and of equals the ASCII-least.
The bound counts what is spent and, for the rest, the cost of a relaxed task in which a conversation may end anywhere;
states from which the search failed keep the higher bound that it learned there, and are not entered again below it.

The rows of a conversation reach its task in order and as a stream, first their faults and roles (one byte each, which
is all that the search holds), then their texts, so that a conversation of any length needs little memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T


BLANKS = " \t\n\x0b\x0c\r"
#: Fixed costs of the contract.
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
#: States: nothing yet, after s, after u, after a. Where a user or an assistant leads, and what is forced next.
NEXT = (2, 2, 3, 2)
KEEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
ACCEPTED = (0, 3)
SOUND, BLANK, DUPLICATE, CUT = range(4)
REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def edits(code: int | None, state: int) -> Iterator[tuple[str, int, int, int]]:
    """(letter, rows used, state after, cost) in ASCII order; code: fault * 4 + place of the initial in `sua?`, None at the end."""
    if code is not None:
        yield "D", 1, state, DELETE
    yield "I", 0, NEXT[state], INSERT
    if code is not None and code // 4 in (SOUND, CUT):
        extra = TRUNCATED if code // 4 == CUT else 0
        kept = KEEP.get((state, "sua?"[code % 4]))
        if kept is not None:
            yield "K", 1, kept, extra
        yield "R", 1, NEXT[state], REROLE + extra


def to_go(codes: bytes) -> list[list[int]]:
    """Of every place and state, the least cost of the rest if the conversation may end in any state."""
    below = [0, 0, 0, 0]
    out = [below]
    for code in reversed(codes):
        own = [min(cost + below[after] for _, used, after, cost in edits(code, q) if used) for q in range(4)]
        for _ in (1, 2):  # two insertions in a row at most are of use
            own = [min(own[q], INSERT + own[NEXT[q]]) for q in range(4)]
        out.append(below := own)
    return out[::-1]


def cheapest(codes: bytes) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits, of equals the ASCII-least."""
    relaxed, n = to_go(codes), len(codes)
    learned: dict[tuple[int, int], int] = {}  # failed states: what the rest costs at least
    bound = relaxed[0][0]
    while True:
        path: list[str] = []
        children = lambda i, q: edits(codes[i] if i < n else None, q)
        stack = [[0, 0, bound, children(0, 0), 1 << 60]]  # place, state, left to spend, edits to try, least cost seen below
        while stack:
            node = stack[-1]
            i, q, left = node[:3]
            if i == n and q in ACCEPTED:
                return bound - left, "".join(path)
            for letter, used, after, cost in node[3]:
                rest = learned.get((i + used, after), relaxed[i + used][after])
                if cost + rest > left:
                    node[4] = min(node[4], cost + rest)
                    continue
                path.append(letter)
                stack.append([i + used, after, left - cost, children(i + used, after), 1 << 60])
                break
            else:
                learned[i, q] = max(learned.get((i, q), relaxed[i][q]), node[4])
                stack.pop()
                if stack:  # the edit that led here, with what was learned of it
                    path.pop()
                    above = stack[-1]
                    above[4] = min(above[4], above[2] - left + learned[i, q])
        bound = learned[0, 0]


def applied(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the repaired turns; rows: (role, text)."""
    state = 0
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(rows)
        if letter == "D":
            continue
        if letter in "IR":
            role = "user" if NEXT[state] == 2 else "assistant"
        state = KEEP[state, role[:1]]
        yield letter, role, text


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copy, gone: `rows` with the faults that crc32(`conv_id:turn`) % 20 deals out (0: gone, 1: empty
    text, 2: without `.!?`, 3: twice, 4: role user). Nulls count as one space, in role and text and in the key."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"), F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"), (kind == 0).alias("gone"),
    )


def _in_order(rows: DataFrame) -> DataFrame:
    """The rows twice, sorted within conversations: without texts (phase 0), then with them. One shuffle, by conversation."""
    digest = F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"))
    gone = F.col("gone") if "gone" in rows.columns else F.lit(False)
    copy = F.col("copy") if "copy" in rows.columns else F.lit(0)
    own = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), copy.alias("copy"), gone.alias("gone"))
    own = own.withColumn("digest", digest).repartition("conv_id")
    seen = F.row_number().over(Window.partitionBy("conv_id", "gone", "digest").orderBy("turn", "copy"))
    last = F.substring(F.rtrim(F.col("text"), F.lit(BLANKS)), -1, 1)
    fault = F.when(last == "", BLANK).when(F.col("nth") > 1, DUPLICATE).when(~last.isin(".", "!", "?"), CUT).otherwise(SOUND)
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    own = own.withColumn("nth", seen).withColumn("code", F.when(F.col("gone"), -1).otherwise(fault * 4 + kind).cast("int"))
    twice = own.withColumn("phase", F.explode(F.array(F.lit(0), F.lit(1)))).where(~F.col("gone") | (F.col("phase") == 0))
    return twice.sortWithinPartitions("conv_id", "phase", "turn", "role", "digest", "nth").select("conv_id", "phase", F.col("turn").cast("long").alias("turn"), "code", "role", F.when(F.col("phase") == 1, F.col("text")).alias("text"))


class _Conversation:
    """What is known of a conversation while its rows pass by."""

    def __init__(self, conv_id):
        self.conv_id, self.codes, self.illegal, self.turns, self.low, self.high, self.last, self.plan = conv_id, bytearray(), 0, 0, None, None, None, None

    def sees(self, turn: int | None, code: int, role: str) -> None:
        if code < 0:
            return
        if self.codes and self.last[0] + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        if turn is not None and (self.low is None or turn != self.high):
            self.turns, self.low, self.high = self.turns + 1, turn if self.low is None else self.low, turn
        self.last = (role[:1],)
        self.codes.append(code)

    def planned(self) -> None:
        if self.plan is None:
            self.plan = cheapest(bytes(self.codes))

    def faults(self) -> list[int]:
        gaps = self.high - self.low + 1 - self.turns if self.low is not None else 0
        return [gaps, *(sum(c // 4 == k for c in self.codes) for k in (BLANK, DUPLICATE, CUT)), self.illegal]


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Conversation, Iterator[tuple[str, str]]]]:
    """Each conversation, its plan made, with the stream of its texts, which must be used up before the next one is asked for."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
    ahead = next(rows, None)

    def texts(conv: _Conversation) -> Iterator[tuple[str, str]]:
        nonlocal ahead
        while ahead is not None and ahead[0] == conv.conv_id and ahead[1] == 1:
            row, ahead = ahead, next(rows, None)
            yield row[4], row[5]

    while ahead is not None:
        conv = _Conversation(ahead[0])
        while ahead is not None and ahead[0] == conv.conv_id and ahead[1] == 0:
            conv.sees(*ahead[2:5])
            ahead = next(rows, None)
        conv.planned()
        yield conv, texts(conv)


def _conv_field(rows: DataFrame) -> T.StructField:
    return next(f for f in rows.schema.fields if f.name.lower() == "conv_id")


def report(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 for every conversation.

    rows: conv_id, turn, role, text, and if wanted copy (order among equal rows) and gone (rows that only say that their
    conversation was there). Rows stand by turn (nulls first), rows of one turn by role and a digest of role and text. Null
    roles and texts count as one space; rows of a null conv_id are one conversation; repeated rows are duplicates. Texts of
    any length pass through as a stream. A conversation all of whose rows are gone has zeros, an empty audit and the hash of
    the empty string; an empty table has no rows. Other columns are left out, whatever their names.
    """
    kind = _conv_field(rows)
    schema = T.StructType([T.StructField("conv_id", kind.dataType), *T.StructType.fromDDL(REPORT).fields])

    def reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = []

        def table() -> pa.RecordBatch:
            types = [conv_type, *[pa.int64()] * 6, pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], schema.names)

        conv_type = pa.null()

        def noted() -> Iterator[pa.RecordBatch]:
            nonlocal conv_type
            for batch in batches:
                conv_type = batch.schema.field(0).type
                yield batch

        for conv, texts in _streamed(noted()):
            cost, audit = conv.plan
            digest, first = hashlib.sha256(), True
            for _, role, text in applied(audit, texts):
                digest.update(b"" if first else b"\n")
                digest.update(role.encode() + b":" + text.encode("utf-8", "replace"))
                first = False
            for _ in texts:
                pass
            out.append([conv.conv_id, *conv.faults(), cost, audit, digest.hexdigest()])
            if len(out) >= 5000:
                yield table()
                out.clear()
        if out:
            yield table()

    return _in_order(rows).mapInArrow(reports, schema)


def repaired(rows: DataFrame) -> DataFrame:
    """conv_id, place (from 0), edit, role, text: the turns of the repaired conversations (rows as in `report`)."""
    schema = T.StructType([T.StructField("conv_id", _conv_field(rows).dataType), *T.StructType.fromDDL("place long, edit string, role string, text string").fields])

    def turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds: list[pa.DataType] = []

        def noted() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kinds[:] = [batch.schema.field(0).type]
                yield batch

        def table(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((kinds[0], pa.int64(), pa.string(), pa.string(), pa.string()))], schema.names)

        out, size = [], 0
        for conv, texts in _streamed(noted()):
            for place, (edit, role, text) in enumerate(applied(conv.plan[1], texts)):
                out.append((conv.conv_id, place, edit, role, text))
                size += len(text)
                if size > 1_000_000 or len(out) > 5000:
                    yield table(out)
                    out, size = [], 0
            for _ in texts:
                pass
        if out:
            yield table(out)

    return _in_order(rows).mapInArrow(turns, schema)
