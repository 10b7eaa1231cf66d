"""Chat formatting by grammar round trip.

A rendered turn is ``### role :\\nbody </turn>\\n``. The parser is deterministic: a turn starts
with the turn mark, its role ends at the first unescaped colon and line end, its body at the first
unescaped end mark, each after one blank; an unescaped turn mark inside a body is an error. Of a
run of backslashes right before a mark one is dropped when it is read.

Each turn is rendered plain first, parsed again and compared with its source. While what is
recovered differs, the content that conflicts is escaped, the body's marks first, then the role's.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Collection, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TURN, HEAD_END, END = "###", ":\n", "</turn>"
#: Rendered characters after which a conversation goes on in a further row.
CHUNK = 1 << 20

_ROLE_MARK = re.compile(rf"(\\*)({HEAD_END})")
_BODY_MARK = re.compile(rf"(\\*)({TURN}|{END})")


class Malformed(ValueError):
    """Text that is not in the grammar."""


def _field(text: str, at: int, mark: re.Pattern, ends: str) -> tuple[str, int, int]:
    """The content from ``at``, where it ends, and where the text goes on."""
    parts = []
    for m in mark.finditer(text, at):
        if m[1]:
            parts += [text[at : m.start()], m[1][1:], m[2]]
            at = m.end()
        elif m[2] == ends and text.startswith(" ", m.start() - 1) and at < m.start():
            return "".join([*parts, text[at : m.start() - 1]]), m.start() - 1, m.end()
        else:
            raise Malformed(f"a {m[2]!r} at {m.start()}")
    raise Malformed(f"no {ends!r} after {at}")


def parse(text: str) -> Iterator[tuple[str, str, int, int]]:
    """role, text and the span of the body in ``text``, turn by turn."""
    at = 0
    while at < len(text):
        if not text.startswith(f"{TURN} ", at):
            raise Malformed(f"no turn at {at}")
        role, _, begin = _field(text, at + len(TURN) + 1, _ROLE_MARK, HEAD_END)
        body, end, after = _field(text, begin, _BODY_MARK, END)
        if not text.startswith("\n", after):
            raise Malformed(f"no line end at {after}")
        yield role, body, begin, end
        at = after + 1


def _escaped(content: str, mark: re.Pattern) -> str:
    return mark.sub(r"\\\1\2", content)


def unescaped(content: str, mark: re.Pattern = _BODY_MARK) -> str:
    return mark.sub(lambda m: m[1][1:] + m[2], content)


def render_turn(role: str, text: str) -> str:
    """The turn in the grammar, escaped as far as its round trip needs."""
    body, head = text, role
    for step in ("plain", "body", "head"):
        if step == "body":
            body = _escaped(text, _BODY_MARK)
        elif step == "head":
            head = _escaped(role, _ROLE_MARK)
        rendered = f"{TURN} {head} {HEAD_END}{body} {END}\n"
        try:
            if [(r, t) for r, t, _, _ in parse(rendered)] == [(role, text)]:
                return rendered
        except Malformed:
            continue
    raise Malformed(f"escapes don't make {text[:80]!r} of {role[:80]!r} readable")


def loss_spans(text: str, roles: Collection[str] = ("assistant",)) -> list[tuple[int, int]]:
    """Where a model's loss counts: the bodies of these roles' turns, escapes included."""
    return [(begin, end) for role, _, begin, end in parse(text) if role in roles]


def formatted(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """conv_id, part and the formatted text of every conversation.

    Turns stand in the order of turn, role, text, nulls first; a null role or text is empty. All
    turns without conv_id make one conversation. Repeated rows are turns of their own. A
    conversation of more than about ``chunk`` characters goes on in further parts, each of whole
    turns; an empty table gives none. Other columns are not looked at.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )

    def rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = map(render_turn, batch["role"].to_pylist(), batch["text"].to_pylist())
            columns = [*batch.columns, pa.array(text, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "rendered"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, part, held, size = None, 0, [], 0
        for batch in batches:
            rows = []
            for conv, turn in zip(batch["conv_id"].to_pylist(), batch["rendered"].to_pylist()):
                if held and (conv != key or size >= chunk):
                    rows.append((key, part, "".join(held)))
                    part, held, size = (part + 1 if conv == key else 0), [], 0
                key = conv
                held.append(turn)
                size += len(turn)
            yield _batch(rows, [pa.int64(), pa.int32(), pa.string()], ["conv_id", "part", "formatted"])
        if held:
            rows = [(key, part, "".join(held))]
            yield _batch(rows, [pa.int64(), pa.int32(), pa.string()], ["conv_id", "part", "formatted"])

    kinds = "conv_id long, turn long, role string, text string, rendered string"
    spelled = turns.mapInArrow(rendered, kinds).repartition("conv_id")
    dealt = spelled.sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "rendered")
    return dealt.mapInArrow(joined, "conv_id long, part int, formatted string")


def read_back(chats: DataFrame, roles: Collection[str] = ("assistant",)) -> DataFrame:
    """What the formatted text holds, read from it: conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256 and formatted_chars of every conversation. The parts are read as ``formatted`` gives
    them, one after another, so no conversation has to fit into memory."""

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, key = None, None
        for batch in batches:
            rows = []
            for conv, part, text in zip(*(c.to_pylist() for c in batch.columns)):
                if part == 0:
                    if state:
                        rows.append((key, *state.row()))
                    state, key = _Digest(roles), conv
                state.add(text)
            yield _batch(rows, *_DIGESTS)
        if state:
            yield _batch([(key, *state.row())], *_DIGESTS)

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string"
    return chats.mapInArrow(digested, f"{schema}, formatted_chars long")


_DIGESTS = (
    [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()],
    ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
)


def _batch(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in kinds]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


class _Digest:
    def __init__(self, roles: Collection[str]):
        self.roles = roles
        self.turns = self.loss = self.chars = 0
        self.all, self.trained = hashlib.sha256(), hashlib.sha256()

    def add(self, text: str) -> None:
        self.chars += len(text)
        for role, body, _, _ in parse(text):
            self.turns += 1
            self.all.update(f"{role}\n{body}\n".encode())
        for begin, end in loss_spans(text, self.roles):
            body = unescaped(text[begin:end])
            self.loss += len(body)
            self.trained.update(body.encode())

    def row(self) -> tuple:
        return self.turns, self.all.hexdigest(), self.loss, self.trained.hexdigest(), self.chars
