"""Repair of conversations by their cheapest edits.

A conversation is a string of symbols, one for each row: the role's initial and
the row's fault. What a symbol does to the costs of the four states in which a
repaired conversation may be is a min-plus matrix; a run of equal symbols is a
power of it, made of cached squares. Matrices of consecutive parts multiply, so
a conversation of any length is cut into parts that tasks take by themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from grantledger.llm.common import SPACE, bounded_batches
from grantledger.llm.ranking import in_order
from grantledger.session import settle

# fixed values: the costs of the edits
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

#: States of a repaired conversation: nothing yet, after a system row, after a user's, after an assistant's.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
#: Where the next user's or assistant's row leads; what an insertion or a new role adds.
NEXT = (USER, USER, ASSISTANT, USER)
#: Where a kept row of an initial leads from each state.
KEPT = {
    "s": {EMPTY: SYSTEM},
    "u": {EMPTY: USER, SYSTEM: USER, ASSISTANT: USER},
    "a": {USER: ASSISTANT},
    "x": {},
}
#: Insertions that end a conversation.
AT_END = (0, 2, 1, 0)

# the second letter of a symbol
SOUND, CUT, BLANK, DUPLICATE = "-", "t", "b", "d"

Matrix = tuple[tuple[float, ...], ...]
Costs = tuple[float, ...]
FAR = float("inf")
#: Rows of a run whose costs are held at once while its choices are unrolled.
UNROLLED = 1024


def product(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(a[i][k] + b[k][j] for k in range(4)) for j in range(4)) for i in range(4))


def applied(a: Matrix, costs: Costs) -> Costs:
    return tuple(min(a[i][k] + costs[k] for k in range(4)) for i in range(4))


UNIT: Matrix = tuple(tuple(0 if i == j else FAR for j in range(4)) for i in range(4))


def row_edits(symbol: str, state: int) -> list[tuple[str, int, float]]:
    """Edits of a row of that symbol: initial, next state, cost; in ASCII order."""
    edits: list[tuple[str, int, float]] = [("D", state, DELETE)]
    if symbol[1] not in (BLANK, DUPLICATE):
        more = TRUNCATED if symbol[1] == CUT else 0
        if state in KEPT[symbol[0]]:
            edits.append(("K", KEPT[symbol[0]][state], more))
        edits.append(("R", NEXT[state], REROLE + more))
    return edits


@cache
def power(symbol: str, doublings: int) -> Matrix:
    """The costs from state to state over 2**doublings rows of one symbol, with insertions before each of them."""
    if doublings:
        half = power(symbol, doublings - 1)
        return product(half, half)
    step = [[FAR] * 4 for _ in range(4)]
    for state in range(4):
        reached, paid = state, 0
        for _ in range(3):  # two insertions lead back to where one can be
            for _, then, cost in row_edits(symbol, reached):
                step[state][then] = min(step[state][then], paid + cost)
            reached, paid = NEXT[reached], paid + INSERT
    return tuple(map(tuple, step))


def over_run(symbol: str, length: int) -> Matrix:
    out, doublings = UNIT, 0
    while length:
        if length & 1:
            out = product(out, power(symbol, doublings))
        length >>= 1
        doublings += 1
    return out


def before_run(symbol: str, length: int, costs: Costs) -> Costs:
    doublings = 0
    while length:
        if length & 1:
            costs = applied(power(symbol, doublings), costs)
        length >>= 1
        doublings += 1
    return costs


def runs_of(symbols: str) -> list[tuple[str, int]]:
    """Equal symbols that follow each other, collapsed."""
    each = (symbols[i : i + 2] for i in range(0, len(symbols), 2))
    return [(symbol, sum(1 for _ in run)) for symbol, run in groupby(each)]


def matrix_of(symbols: str) -> Matrix:
    out = UNIT
    for symbol, length in runs_of(symbols):
        out = product(out, over_run(symbol, length))
    return out


END: Costs = tuple(float(INSERT * n) for n in AT_END)


def unrolled(symbols: str, entry: int, after: Costs, is_last: bool) -> tuple[str, int]:
    """The ASCII-least of the cheapest edits of a part, and the state it ends in.

    `after` are the costs from each state at the part's end to the conversation's end.
    """
    pieces: list[tuple[str, int, Costs]] = []
    costs = after
    for symbol, length in reversed(runs_of(symbols)):
        while length:
            piece = min(length, UNROLLED)
            pieces.append((symbol, piece, costs))
            costs = before_run(symbol, piece, costs)
            length -= piece
    state, audit = entry, []
    for symbol, length, costs in reversed(pieces):
        one = power(symbol, 0)
        left = [costs]
        for _ in range(length):
            left.append(applied(one, left[-1]))
        for i in range(length, 0, -1):
            while True:
                paid = left[i][state]
                rows = {edit: then for edit, then, cost in row_edits(symbol, state) if cost + left[i - 1][then] == paid}
                edit = "D" if "D" in rows else "I" if INSERT + left[i][NEXT[state]] == paid else min(rows)
                audit.append(edit)
                if edit != "I":
                    state = rows[edit]
                    break
                state = NEXT[state]
    if is_last:
        audit.append("I" * AT_END[state])
    return "".join(audit), state


def illegal_of(initials: str) -> int:
    return sum(initials[i : i + 2] not in ("su", "ua", "au") for i in range(len(initials) - 1))


def _mapped(function: Callable, schema: T.StructType) -> Callable:
    """Rows of a table to any number of rows each, batch by batch."""
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [row for given in batch.to_pylist() for row in function(given)]
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return run


def _apply(df: DataFrame, function: Callable, *fields: tuple[str, T.DataType | str]) -> DataFrame:
    schema = T.StructType(
        [T.StructField(n, T._parse_datatype_string(k) if isinstance(k, str) else k) for n, k in fields]
    )
    return df.mapInArrow(_mapped(function, schema), schema)


def _summary(row: dict) -> Iterator[dict]:
    symbols = row["symbols"]
    costs = [None if c == FAR else int(c) for line in matrix_of(symbols) for c in line]
    yield {**row, "costs": costs, "illegal": illegal_of(symbols[::2]), "head": symbols[0], "tail": symbols[-2]}


def _chain_costs(row: dict) -> Iterator[dict]:
    """For each part of a conversation the costs after it; for the conversation its cost and illegal neighbours."""
    parts = sorted(row["parts"], key=lambda p: p["__range"])
    after, ends = END, []
    for part in reversed(parts):
        ends.append(after)
        flat = [FAR if c is None else c for c in part["costs"]]
        after = applied(tuple(tuple(flat[i : i + 4]) for i in range(0, 16, 4)), after)
    between = sum(p["tail"] + q["head"] not in ("su", "ua", "au") for p, q in zip(parts, parts[1:], strict=False))
    illegal = between + sum(p["illegal"] for p in parts)
    for i, (part, end) in enumerate(zip(parts, reversed(ends), strict=True)):
        yield {
            "conv_id": row["conv_id"], "__range": part["__range"], "after": [int(c) for c in end],
            "is_first": i == 0, "is_last": i + 1 == len(parts), "cost": int(after[EMPTY]), "illegal": illegal,
        }


def _options(row: dict) -> Iterator[dict]:
    """The edits of a part for each state in which it may begin."""
    begins = [EMPTY] if row["is_first"] else range(4)
    done = {s: unrolled(row["symbols"], s, tuple(map(float, row["after"])), row["is_last"]) for s in begins}
    yield {
        "conv_id": row["conv_id"], "__range": row["__range"], "first_place": row["first_place"],
        "audits": [done.get(s, (None, None))[0] for s in range(4)],
        "leaves": [done.get(s, (None, None))[1] for s in range(4)],
    }


def _chain_states(row: dict) -> Iterator[dict]:
    state = EMPTY
    for part in sorted(row["parts"], key=lambda p: p["__range"]):
        yield {"conv_id": row["conv_id"], "__range": part["__range"], "entry": state}
        state = part["leaves"][state]


def _edits(row: dict) -> Iterator[dict]:
    """One row for each edit of a part: the row it is about, and the role that it gives."""
    state, place = row["entry"], row["first_place"]
    for number, edit in enumerate(row["audits"][state]):
        role = None
        if edit in "IR":
            state = NEXT[state]
            role = "user" if state == USER else "assistant"
        elif edit == "K":
            initial = row["symbols"][2 * (place - row["first_place"])]
            state = KEPT[initial][state]
        yield {
            "conv_id": row["conv_id"], "__range": row["__range"], "number": number, "edit": edit,
            "__place": None if edit == "I" else place, "new_role": role,
        }
        place += edit != "I"


class Repair:
    """The repair of `turns` (conv_id, turn, role, text).

    A conversation's rows follow by turn, null first, then role and text, as
    bytes; null roles and texts count as empty. The first fault of a row counts:
    blank (nothing but white space), duplicate (role and text seen earlier in
    the conversation), truncated (the last sign that is not white space is none
    of `.!?`). The cheapest edits that give roles `(s?(ua)+)?` by their initials
    are taken, of equally cheap ones the ASCII-least initials. Repeated rows are
    rows of their own; a null conversation id is a conversation. Other columns
    are not read. An empty table has no conversation.
    """

    def __init__(self, turns: DataFrame) -> None:
        bounded_batches(turns.sparkSession)
        kind = turns.schema["conv_id"].dataType
        rows = turns.select(
            "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
        )
        #: all rows with their places: `__range`, the part of the table, and `__place` in it
        self.ordered = in_order(rows, F.col("conv_id"), F.col("turn"), F.col("role"), F.col("text"))
        self.faulty = settle(self._with_faults(), "faults")
        symbol = F.concat(
            F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise(F.lit("x")), F.col("fault")
        )
        # a part is what a range holds of a conversation, so no part is longer than a range
        listed = F.sort_array(F.collect_list(F.struct("__place", symbol.alias("symbol"))))
        parts = self.faulty.groupBy("__range", "conv_id").agg(
            F.min("__place").alias("first_place"), F.array_join(F.transform(listed, lambda s: s["symbol"]), "").alias("symbols")
        )
        own = (("conv_id", kind), ("__range", "long"), ("first_place", "long"), ("symbols", "string"))
        parts = settle(
            _apply(parts.select(*(n for n, _ in own)), _summary, *own, ("costs", "array<long>"), ("illegal", "long"),
                   ("head", "string"), ("tail", "string")),
            "parts",
        )
        # a conversation has at most as many parts as there are ranges
        whole = parts.groupBy("conv_id").agg(
            F.collect_list(F.struct("__range", "costs", "illegal", "head", "tail")).alias("parts")
        )
        after = settle(
            _apply(whole, _chain_costs, ("conv_id", kind), ("__range", "long"), ("after", "array<long>"),
                   ("is_first", "boolean"), ("is_last", "boolean"), ("cost", "long"), ("illegal", "long")),
            "costs",
        )
        #: `conv_id`, `cost` and `illegal` (neighbours that are not system-user, user-assistant or assistant-user)
        self.costs = after.where("is_first").select("conv_id", "cost", "illegal")
        ends = after.select(
            F.col("conv_id").alias("__c"), F.col("__range").alias("__r"), "after", "is_first", "is_last"
        )
        known = parts.select("conv_id", "__range", "first_place", "symbols")
        at_part = lambda df: (known["__range"] == df["__r"]) & known["conv_id"].eqNullSafe(df["__c"])
        options = settle(
            _apply(
                known.join(ends, at_part(ends)).drop("__c", "__r"), _options, ("conv_id", kind), ("__range", "long"),
                ("first_place", "long"), ("audits", "array<string>"), ("leaves", "array<int>"),
            ),
            "options",
        )
        chains = options.groupBy("conv_id").agg(F.collect_list(F.struct("__range", "leaves")).alias("parts"))
        entries = _apply(chains, _chain_states, ("conv_id", kind), ("__range", "long"), ("entry", "int"))
        entries = entries.select(F.col("conv_id").alias("__c"), F.col("__range").alias("__r"), "entry")
        chosen = options.select(F.col("conv_id").alias("__c2"), F.col("__range").alias("__r2"), "audits")
        joined = known.join(entries, at_part(entries)).join(
            chosen, (F.col("__r") == F.col("__r2")) & F.col("__c").eqNullSafe(F.col("__c2"))
        )
        edits = _apply(
            joined.select("conv_id", "__range", "first_place", "symbols", "audits", "entry"), _edits, ("conv_id", kind),
            ("__range", "long"), ("number", "long"), ("edit", "string"), ("__place", "long"), ("new_role", "string"),
        )
        #: one row for each edit in order of `__range`, `number`: its initial, and the role and text that it leaves
        rows = self.ordered.select(F.col("__range").alias("__r"), F.col("__place").alias("__p"), "role", "text")
        self.edits = edits.join(rows, (edits["__range"] == rows["__r"]) & (edits["__place"] == rows["__p"]), "left").select(
            "conv_id", "__range", "number", "edit", F.coalesce("new_role", "role").alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        self._kind = kind

    def _with_faults(self) -> DataFrame:
        rows = self.ordered
        shown = F.rtrim("text", F.lit(" \t\n\x0b\f\r"))
        blank = ~F.col("text").rlike(f"[^{SPACE}]")
        firsts = rows.where(~blank).groupBy("conv_id", "role", "text").agg(
            F.min(F.struct("__range", "__place")).alias("first")
        ).select(F.col("first.__range").alias("__r"), F.col("first.__place").alias("__p"), F.lit(True).alias("is_first"))
        marked = rows.join(firsts, (rows["__range"] == firsts["__r"]) & (rows["__place"] == firsts["__p"]), "left")
        fault = (
            F.when(blank, F.lit(BLANK))
            .when(F.col("is_first").isNull(), F.lit(DUPLICATE))
            .when(~F.right(shown, F.lit(1)).isin(".", "!", "?"), F.lit(CUT))
            .otherwise(F.lit(SOUND))
        )
        return marked.select("conv_id", "turn", "__range", "__place", F.left("role", F.lit(1)).alias("initial"), fault.alias("fault"))

    def faults(self) -> DataFrame:
        """For each conversation its faults, `gaps` in its turns (null beyond 64 bits), `illegal` neighbours and `cost`."""
        count = lambda fault: F.count_if(F.col("fault") == fault)
        found = self.faulty.groupBy("conv_id").agg(
            F.min("turn").alias("least"), F.max("turn").alias("most"), F.count_distinct("turn").alias("different"),
            count(BLANK).alias("blank"), count(DUPLICATE).alias("duplicate"), count(CUT).alias("truncated"),
        )
        span = F.try_subtract(F.try_subtract(F.col("most"), F.col("least")), F.col("different") - 1)
        gaps = F.when(F.col("different") == 0, F.lit(0)).otherwise(span).cast("long").alias("gaps")
        found = found.select(F.col("conv_id").alias("__c"), gaps, "blank", "duplicate", "truncated")
        return self.costs.join(found, F.col("conv_id").eqNullSafe(F.col("__c"))).drop("__c")

    def digests(self) -> DataFrame:
        """`conv_id`, `audit` (the edits' initials) and `repaired_sha256` (`role:text` of what is left, newline-joined).

        A digest takes a text from its beginning to its end, so one task passes
        over a conversation; it holds a batch of rows and the audit.
        """
        at = self.edits.repartition("conv_id").sortWithinPartitions("conv_id", "__range", "number")
        kind = to_arrow_type(self._kind)

        def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, audit, sha, is_open = None, [], hashlib.sha256(), False
            done: list[tuple] = []
            for batch in batches:
                for row in batch.to_pylist():
                    if is_open and row["conv_id"] != now:
                        done.append((now, "".join(audit), sha.hexdigest()))
                        is_open = False
                    if not is_open:
                        now, audit, sha, is_open, joint = row["conv_id"], [], hashlib.sha256(), True, ""
                    audit.append(row["edit"])
                    if row["edit"] != "D":
                        sha.update(f"{joint}{row['role']}:{row['text']}".encode())
                        joint = "\n"
                yield _digest_rows(done, kind)
                done = []
            if is_open:
                yield _digest_rows([(now, "".join(audit), sha.hexdigest())], kind)

        schema = T.StructType(
            [T.StructField("conv_id", self._kind), T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())]
        )
        return at.select("conv_id", "edit", "role", "text").mapInArrow(digest, schema)


def _digest_rows(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    ids, audits, digests = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, kind), pa.array(audits, pa.string()), pa.array(digests, pa.string())],
        names=["conv_id", "audit", "repaired_sha256"],
    )


def damaged(turns: DataFrame) -> DataFrame:
    """`turns` with damage that their conversation and turn decide; nulls count as one space.

    By CRC-32 of `conv_id:turn` modulo 20: 0 drops the row, 1 empties its text, 2 takes out `.!?`, 3 repeats it, 4 makes
    it a user's.
    """
    shown = lambda column: F.coalesce(F.col(column).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), kind.alias("kind"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.where("kind != 0").select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, F.lit(""))
        .when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(times).alias("copy"),
    ).drop("copy")
