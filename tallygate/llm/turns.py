"""Repair of conversation structure by the auction algorithm for shortest paths.

A conversation is a lattice: a layer for each row, and in each layer the four states of the role
pattern ``(s?(ua)+)?`` (nothing yet, after system, after user, after assistant). Keeping, changing the
role of, or deleting a row leads to the next layer, inserting an empty turn stays in its own; arcs have
integer costs. The auction keeps a price at every node and a path from the origin. The path's last
node is priced up to its cheapest arc and leaves the path if it was too cheap (contraction), else
the path goes on along that arc (extension), until it arrives. The prices are then dual: on every
cheapest path each arc costs just what the price falls by. Among such tight arcs the edits' initials
are read off least first, taking only nodes from which tight arcs lead to the end.

Conversations may be of any length. Rows are sorted by range, not by conversation, and cut into
parts of at most ``PART`` rows. Where a conversation has several, small matrices of costs from state
to state, one for each part, give the cost to the end from each part's border; with these as the
prices there, parts are solved apart, for each state they may be entered in. The last step streams the
parts of a conversation in order, as a digest over its whole text needs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygate.llm.common import kept

#: Rows, and bytes of text, of a part.
PART = 256
PART_BYTES = 4 << 20
#: Solved lattices that a task remembers.
REMEMBERED = 20_000

RETYPE, DELETE, INSERT, UNFINISHED = 1, 2, 5, 5
SPACE = " \t\n\x0b\x0c\r"
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
#: The states after keeping a row whose role has this initial, and after a new user or assistant turn.
_KEPT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
_TURN = {0: 2, 1: 2, 2: 3, 3: 2}
#: What it costs to end in each state, and by which insertions.
_END = (0, 2 * INSERT, INSERT, 0)
_TAIL = ("", "II", "I", "")
_LEGAL = ("su", "ua", "au")


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of the rows after the damage that crc32 of ``conv_id:turn`` deals out, and
    ``dropped`` for those that it takes away. Nulls are one space, but keep their conversation and place."""
    space = F.lit(" ")
    spelled = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    case = F.crc32(spelled.cast("binary")) % 20
    text = F.coalesce("text", space)
    changed = F.when(case == 1, "").when(case == 2, F.translate(text, ".!?", "")).otherwise(text)
    role = F.when(case == 4, "user").otherwise(F.coalesce("role", space))
    times = F.when(case == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return turns.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), role.alias("role"), changed.alias("text"),
        (case == 0).alias("dropped"), F.explode(times).alias("copy"),
    ).drop("copy")


class Lattice:
    """The lattice of one part. kinds: a byte for each row, 4 * (place of its initial in "sua", or 3) +
    its fault; togo: the cost from each state behind the last row to the end."""

    def __init__(self, kinds: bytes, togo: tuple[int, ...]):
        self.n, self.end = len(kinds), 4 * len(kinds) + 4
        self.arcs: list[list[tuple[str, int, int]]] = []  # (initial, cost, node), initials ascending
        least = []
        for i, kind in enumerate(kinds):
            initial, fault = "sua-"[kind >> 2], kind & 3
            stays = fault in (SOUND, TRUNCATED)
            more = UNFINISHED if fault == TRUNCATED else 0
            least.append(0 if fault == SOUND else DELETE)
            for state in range(4):
                own = [("D", DELETE, 4 * i + 4 + state), ("I", INSERT, 4 * i + _TURN[state])]
                if stays:
                    to = _KEPT.get(initial, {}).get(state)
                    own += [("K", more, 4 * i + 4 + to)] if to is not None else []
                    own.append(("R", RETYPE + more, 4 * i + 4 + _TURN[state]))
                self.arcs.append(own)
        self.arcs += [[("", cost, self.end)] for cost in togo]
        self.price = [0] * (self.end + 1)
        floor = min(togo)  # no arc costs less than the prices fall by
        for i in range(self.n, -1, -1):
            floor += least[i] if i < self.n else 0
            self.price[4 * i : 4 * i + 4] = [floor] * 4

    def auction(self, origin: int) -> None:
        """Raises prices until a path of tight arcs leads from the origin to the end."""
        price, arcs, path = self.price, self.arcs, [origin]
        while path[-1] != self.end:
            node = path[-1]
            cheapest, to = min((cost + price[j], j) for _, cost, j in arcs[node])
            if price[node] < cheapest:
                price[node] = cheapest
                if len(path) > 1:
                    path.pop()
            else:
                path.append(to)

    def _tight(self, node: int) -> list[tuple[str, int]]:
        price = self.price
        return [(letter, j) for letter, cost, j in self.arcs[node] if price[node] == cost + price[j]]

    def trace(self, origin: int) -> tuple[int, str]:
        """The state at the end of the least cheapest path, and its initials."""
        arrives = [False] * self.end + [True]
        for i in range(self.n, -1, -1):
            layer = range(4 * i, 4 * i + 4)
            for _ in range(3):  # insertions lead on within the layer, twice in a row at most
                for node in layer:
                    arrives[node] = arrives[node] or any(arrives[j] for _, j in self._tight(node))
        node, letters = origin, []
        while node < 4 * self.n:
            letter, node = next((letter, j) for letter, j in self._tight(node) if arrives[j])
            letters.append(letter)
        return node - 4 * self.n, "".join(letters)

    def solved(self, entries: range) -> list[tuple[int, int, str]]:
        """For each state to enter in: the cost to the end, the state behind the last row, the initials."""
        found = []
        for state in entries:
            self.auction(state)
            found.append((self.price[state], *self.trace(state)))
        return found


def through(kinds: bytes) -> list[int]:
    """The least cost from each state (four values each) to each state behind the last row."""
    far = 1 << 60
    rows = []
    for entry in range(4):
        cost = [far] * 4
        cost[entry] = 0
        for kind in kinds:
            for state in (0, 1, 3, 2):  # an insertion, then perhaps a second one
                cost[_TURN[state]] = min(cost[_TURN[state]], cost[state] + INSERT)
            initial, fault = "sua-"[kind >> 2], kind & 3
            after = [c + DELETE for c in cost]
            if fault in (SOUND, TRUNCATED):
                more = UNFINISHED if fault == TRUNCATED else 0
                for state, c in enumerate(cost):
                    steps = [(_TURN[state], RETYPE), *((to, 0) for at, to in _KEPT.get(initial, {}).items() if at == state)]
                    for to, own in steps:
                        after[to] = min(after[to], c + own + more)
            cost = after
        rows += [min(c, far) for c in cost]
    return rows


def rendered(roles: list[str], texts: list[str], kinds: bytes, state: int, audit: str) -> list[str]:
    """``role:text`` of the turns that the edits leave."""
    lines, at = [], 0
    for letter in audit:
        new = "assistant" if state == 2 else "user"
        if letter == "I":
            lines.append(new + ":")
        elif letter in "KR":
            lines.append(f"{roles[at] if letter == 'K' else new}:{texts[at]}")
        state = state if letter == "D" else _KEPT["sua"[kinds[at] >> 2]][state] if letter == "K" else _TURN[state]
        at += letter != "I"
    return lines


_KEY = ["unnamed", "conv"]


def _marked(turns: DataFrame) -> DataFrame:
    """The rows with their kind: initial and first fault."""
    bare = F.rtrim("text", F.lit(SPACE))
    rows = turns.select(
        F.col("conv_id").isNull().alias("unnamed"), F.coalesce("conv_id", F.lit(0)).alias("conv"), "turn", "role", "text", "dropped",
        F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("said"),
        F.monotonically_increasing_id().alias("at"),
    )
    rows = kept(rows)
    place = F.struct(F.col("turn").isNotNull(), F.coalesce("turn", F.lit(0)), "at")
    said = ["unnamed", "conv", "said"]
    first = rows.where("not dropped").groupBy(*said).agg(F.min(place).alias("first"))
    fault = (
        F.when(bare == "", BLANK)
        .when(place > F.col("first"), DUPLICATE)
        .when(~F.substring(bare, -1, 1).isin(".", "!", "?"), TRUNCATED)
        .otherwise(SOUND)
    )
    initial = F.substring("role", 1, 1)
    spot = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return rows.join(first, said, "left").withColumn("kind", F.when(F.col("dropped"), -1).otherwise(spot * 4 + fault)).drop("first", "dropped")


_PARTS = (
    "unnamed boolean, conv long, part long, kinds binary, roles array<string>, texts array<string>,"
    " first_turn long, last_turn long, turns long"
)


def _parts(marked: DataFrame, most: int) -> DataFrame:
    """Rows in the order of their conversation, up to ``most`` together; part ascends with them."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [p.split()[0] for p in _PARTS.split(", ")]
        types = [pa.bool_(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.string()), *[pa.int64()] * 3]
        number, key, size = TaskContext.get().partitionId() << 40, None, 0
        kinds, roles, texts, turns = bytearray(), [], [], []
        out = []

        def told() -> Iterator[pa.RecordBatch]:
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out), types)], names)
                out.clear()

        def close() -> None:
            nonlocal number, size, kinds, roles, texts, turns
            if key is not None:
                own = (turns[0], turns[-1], len(set(turns))) if turns else (None, None, 0)
                out.append((*key, number, bytes(kinds), roles, texts, *own))
            number, size, kinds, roles, texts, turns = number + 1, 0, bytearray(), [], [], []

        for batch in batches:
            columns = (batch[c].to_pylist() for c in ("unnamed", "conv", "kind", "role", "text", "turn"))
            held = 0
            for unnamed, conv, kind, role, text, turn in zip(*columns):
                if (unnamed, conv) != key or len(kinds) >= most or size + len(text) > PART_BYTES and size:
                    close()
                    key = (unnamed, conv)
                    if held > PART_BYTES:
                        yield from told()
                        held = 0
                if kind >= 0:
                    kinds.append(kind)
                    roles.append(role)
                    texts.append(text)
                    size += len(text)
                    held += len(text)
                    if turn is not None:
                        turns.append(turn)
            yield from told()
        close()
        yield from told()

    order = [*_KEY, "turn", "role", "said", "at"]
    partitions = int(marked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = marked.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    return kept(dealt.select(*_KEY, "kind", "role", "text", "turn").mapInArrow(cut, _PARTS))


def _costs_behind(parts: DataFrame) -> DataFrame:
    """Of conversations in several parts: the cost from each state behind a part to the end (togo), and
    whether the part is the first."""
    several = parts.groupBy(*_KEY).agg(F.count("*").alias("n")).where("n > 1").select(*_KEY)
    lean = parts.select(*_KEY, "part", "kinds").join(several, _KEY, "left_semi")

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            costs = pa.array([through(k) for k in batch["kinds"].to_pylist()], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch["unnamed"], batch["conv"], batch["part"], costs], [*_KEY, "part", "costs"])

    costs = lean.mapInArrow(passed, "unnamed boolean, conv long, part long, costs array<long>")
    listed = costs.groupBy(*_KEY).agg(F.sort_array(F.collect_list(F.struct("part", "costs"))).alias("parts"))

    def backwards(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for unnamed, conv, parts_ in frame.itertuples(index=False):
                behind = list(_END)
                for k in range(len(parts_) - 1, -1, -1):
                    rows.append((unnamed, conv, parts_[k]["part"], behind, k == 0))
                    own = list(parts_[k]["costs"])
                    behind = [min(own[4 * e + f] + behind[f] for f in range(4)) for e in range(4)]
            yield pd.DataFrame(rows, columns=[*_KEY, "part", "togo", "leads"])

    return listed.mapInPandas(backwards, "unnamed boolean, conv long, part long, togo array<long>, leads boolean")


def _solved(parts: DataFrame) -> DataFrame:
    """unnamed, conv, part with, for each state that it may be entered in, its cost to the end of the
    conversation, the state behind it and the edits' initials."""
    lean = parts.select(*_KEY, "part", "kinds").join(_costs_behind(parts), [*_KEY, "part"], "left")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, list] = {}
        for batch in batches:
            found = []
            for kinds, togo, leads in zip(*(batch[c].to_pylist() for c in ("kinds", "togo", "leads"))):
                at = (kinds, _END if togo is None else tuple(togo), leads is not False)
                if at not in known:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[at] = Lattice(kinds, at[1]).solved(range(1 if at[2] else 4))
                found.append(known[at])
            lists = [pa.array([[x[k] for x in own] for own in found], pa.list_(t)) for k, t in enumerate((pa.int64(), pa.int32(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch["unnamed"], batch["conv"], batch["part"], *lists], [*_KEY, "part", "costs", "exits", "audits"])

    return lean.mapInArrow(solve, "unnamed boolean, conv long, part long, costs array<long>, exits array<int>, audits array<string>")


_RESULT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long,"
    " audit string, repaired_sha256 string, repaired array<string>"
)


class _Conversation:
    """What the parts of one conversation, in order, add up to."""

    def __init__(self, conv_id: int | None, with_turns: bool):
        self.conv_id, self.hash, self.empty = conv_id, hashlib.sha256(), True
        self.state, self.cost, self.audit = 0, None, []
        self.faults, self.illegal, self.before = [0, 0, 0, 0], 0, None
        self.first = self.last = None
        self.turns = 0
        self.lines: list[str] | None = [] if with_turns else None

    def _say(self, lines: list[str]) -> None:
        for line in lines:
            self.hash.update(f"{'' if self.empty else chr(10)}{line}".encode())
            self.empty = False
        if self.lines is not None:
            self.lines += lines

    def add(self, part: dict, solved: dict) -> None:
        at = min(self.state, len(solved["audits"]) - 1)
        if self.cost is None:
            self.cost = solved["costs"][at]
        initials = ["sua-"[k >> 2] for k in part["kinds"]]
        for initial in initials:
            self.illegal += self.before is not None and self.before + initial not in _LEGAL
            self.before = initial
        for k in part["kinds"]:
            self.faults[k & 3] += 1
        if part["turns"]:
            self.turns += part["turns"] - (self.last == part["first_turn"])
            self.first = part["first_turn"] if self.first is None else self.first
            self.last = part["last_turn"]
        self._say(rendered(part["roles"], part["texts"], part["kinds"], self.state, solved["audits"][at]))
        self.audit.append(solved["audits"][at])
        self.state = solved["exits"][at]

    def result(self) -> tuple:
        tail = _TAIL[self.state]
        self._say(rendered([], [], b"", self.state, tail))
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        audit = "".join(self.audit) + tail
        return (self.conv_id, gaps, *self.faults[1:], self.illegal, self.cost, audit, self.hash.hexdigest(), self.lines)


def repaired(turns: DataFrame, with_turns: bool = True, part: int = PART) -> DataFrame:
    """A row for each conversation: gaps, faults, illegal neighbours, the cost and the initials of its
    cheapest edits, the digest of the repaired turns and, ``with_turns``, these as ``role:text``.

    turns: conv_id, turn, role, text without nulls in the last two, and ``dropped``, rows that only
    say that there is such a conversation. Rows go by turn, nulls first; equal turns by role, then by a
    digest of the text. A null conv_id is a conversation of its own. Blank rows hold nothing but
    white space; rows that repeat role and text of an earlier one are duplicates; an empty role has no
    initial and can't be kept. Other columns are not looked at; an empty table gives none.
    """
    parts = _parts(_marked(turns), part)
    both = parts.withColumn("found", F.lit(False)).unionByName(_solved(parts).withColumn("found", F.lit(True)), allowMissingColumns=True)
    dealt = both.repartition(*_KEY).sortWithinPartitions(*_KEY, "part", F.desc("found"))

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [p.split()[0] for p in _RESULT.split(", ")]
        types = [*[pa.int64()] * 7, pa.string(), pa.string(), pa.list_(pa.string())]
        key = now = solved = None
        out: list[tuple] = []
        for batch in batches:
            for row in (r for k in range(batch.num_rows) for r in batch.slice(k, 1).to_pylist()):
                if row["found"]:
                    solved = row
                    continue
                if (row["unnamed"], row["conv"]) != key:
                    if now is not None:
                        out.append(now.result())
                    key = (row["unnamed"], row["conv"])
                    now = _Conversation(None if row["unnamed"] else row["conv"], with_turns)
                now.add(row, solved)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out), types)], names)
                out = []
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], kind) for v, kind in zip(now.result(), types)], names)

    found = dealt.mapInArrow(streamed, _RESULT)
    return found if with_turns else found.drop("repaired")
