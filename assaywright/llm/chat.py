"""Chat formatting: layouts known by the fingerprint of their fields, canonical turns, a reversible template.

A record's fingerprint is the hash of the sorted nested paths of its fields that
are not NULL (``messages[].role``), among the paths that any layout names.  The
layout with that fingerprint says, as data, where roles and texts are.  Records
of no layout are kept apart by ``unmatched``.

A turn is written as ``### role: text</turn>`` and a line end.  In texts a
control string gets a backslash and the backslashes before it are doubled, as
are those at the end; so control strings of the template are those that follow
an even number of backslashes, and reading gives back every text.  A turn is a
row, so a conversation of any length is never held in one place.

Defined results: NULL text and NULL role are empty; a NULL conversation id is a
conversation of its own; turns are ordered by number (NULL first), ties by what
they say; repeated rows are repeated turns; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.storage import stored

HEAD, END, LINE_END = "###", "</turn>", "\n"
TURNS = "array<struct<turn:bigint,role:string,text:string>>"


@dataclass(frozen=True)
class Layout:
    """Where the turns of a record are.

    One of: ``fixed`` (role, path of its text) in order; ``each`` (array, role
    field, text field); ``row`` (turn number, role, text) for tables with one
    turn a row.  A path in ``optional`` may be NULL.  ``roles`` renames roles.
    """

    name: str
    fixed: tuple[tuple[str, str], ...] = ()
    each: tuple[str, str, str] | None = None
    row: tuple[str, str, str] | None = None
    optional: tuple[str, ...] = ()
    roles: tuple[tuple[str, str], ...] = ()

    @property
    def paths(self) -> set[str]:
        if self.each:
            return {f"{self.each[0]}[].{f}" for f in self.each[1:]}
        return set(self.row) if self.row else {path for _, path in self.fixed}

    def fingerprints(self) -> list[int]:
        always = self.paths - set(self.optional)
        maybe = sorted(self.paths & set(self.optional))
        return [hash_of(always | set(more)) for n in range(len(maybe) + 1) for more in combinations(maybe, n) if always or more or self.row]

    def turns(self) -> Column:
        roles = {old: new for old, new in self.roles}

        def turn(number, role, text):
            for old, new in roles.items():
                role = F.when(role == old, F.lit(new)).otherwise(role)
            return F.struct(number.cast("long").alias("turn"), role.alias("role"), text.alias("text"))

        if self.row:
            number, role, text = map(F.col, self.row)
            return F.array(turn(number, role, text)).cast(TURNS)
        if self.each:
            array, role, text = self.each
            return F.transform(F.col(array), lambda x, i: turn(i, x[role], x[text])).cast(TURNS)
        said = [F.when(F.col(p).isNotNull(), turn(F.lit(i), F.lit(role), F.col(p))) for i, (role, p) in enumerate(self.fixed)]
        return F.array_compact(F.array(*said)).cast(TURNS)


_NAMES = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant"))
LAYOUTS = (
    Layout("turn rows", row=("turn", "role", "text"), optional=("turn", "role", "text")),
    Layout("messages", each=("messages", "role", "content"), roles=_NAMES),
    Layout("conversations", each=("conversations", "from", "value"), roles=_NAMES),
    Layout("prompt and response", fixed=(("system", "system"), ("user", "prompt"), ("assistant", "response")), optional=("system",)),
    Layout("instruction", fixed=(("user", "instruction"), ("user", "input"), ("assistant", "output")), optional=("input",)),
    Layout("question and answer", fixed=(("user", "question"), ("assistant", "answer"))),
)


def hash_of(paths: set[str]) -> int:
    """The 64-bit hash of a set of field paths, the same as ``fingerprint`` computes."""
    value = xxhash.xxh64_intdigest("\n".join(sorted(paths)), 42)
    return value - (1 << 64) if value >> 63 else value


def field_paths(schema: T.StructType, prefix: str = "") -> dict[str, tuple[str, str]]:
    """Nested paths, each with the column that holds it and, within an array, the field asked for."""
    found = {}
    for f in schema.fields:
        path = f"{prefix}{f.name}"
        kind = f.dataType
        if isinstance(kind, T.StructType):
            found |= field_paths(kind, f"{path}.")
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            found |= {f"{path}[].{x.name}": (path, x.name) for x in kind.elementType.fields}
        else:
            found[path] = (path, "")
    return found


def _field(name: str):
    return lambda x: x[name]


def fingerprint(schema: T.StructType, layouts: Sequence[Layout]) -> Column:
    """Hash of a record's paths that are not NULL, among those some layout names."""
    named = set().union(*[x.paths for x in layouts])
    parts = []
    for path, (column, inner) in sorted(field_paths(schema).items()):
        if path in named:
            there = F.exists(F.transform(column, _field(inner)), lambda x: x.isNotNull()) if inner else F.col(column).isNotNull()
            parts.append(F.when(there, F.lit(path)))
    return F.xxhash64(F.concat_ws("\n", *parts))


def _with_turns(records: DataFrame, layouts: Sequence[Layout]) -> DataFrame:
    there = set(field_paths(records.schema))
    usable = [x for x in layouts if x.paths - set(x.optional) <= there and (x.paths <= there or not x.row and not x.each)]
    turns = F.lit(None).cast(TURNS)
    rows = records.withColumn("__fingerprint", fingerprint(records.schema, layouts))
    for layout in usable:
        if layout.fixed:
            layout = Layout(layout.name, tuple(x for x in layout.fixed if x[1] in there), optional=layout.optional, roles=layout.roles)
        turns = F.when(F.col("__fingerprint").isin(layout.fingerprints()), layout.turns()).otherwise(turns)
    return rows.withColumn("__turns", turns)


def canonical(records: DataFrame, key: str, layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """Turns of all records of a known layout: key, turn, role, text."""
    rows = _with_turns(records, layouts).select(F.col(f"`{key}`").alias("key"), F.explode("__turns").alias("t"))
    empty = F.lit("")
    return rows.select("key", "t.turn", F.coalesce("t.role", empty).alias("role"), F.coalesce("t.text", empty).alias("text"))


def unmatched(records: DataFrame, layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """Records of no known layout, columns as given and ``__fingerprint``."""
    return _with_turns(records, layouts).where("__turns is null").drop("__turns")


def formatted(turns: DataFrame) -> DataFrame:
    """Each turn as a segment of the formatted text, with the loss mask as a span of it (assistant texts)."""
    control = rf"(?<!\\)(\\*)({HEAD}|{END})"
    text = F.regexp_replace(F.regexp_replace("text", control, r"$1$1\\$2"), r"(?<!\\)(\\+)\z", "$1$1")
    role = F.regexp_replace("role", r"([\\:#<])", r"\\$1")
    head = F.concat(F.lit(f"{HEAD} "), role, F.lit(": "))
    learned = F.col("role") == "assistant"
    return turns.select(
        "key", "turn", F.concat(head, text, F.lit(END + LINE_END)).alias("segment"),
        F.when(learned, F.length(head)).alias("loss_start"),
        F.when(learned, F.length(head) + F.length(text)).alias("loss_end"),
    )


_CONTROL = re.compile(rf"(?<!\\)(\\*)({HEAD}|{END})")
_TAIL = re.compile(r"(?<!\\)(\\+)\Z")


def unescaped(text: str) -> str:
    text = _TAIL.sub(lambda m: m[1][: len(m[1]) // 2], text)
    return _CONTROL.sub(lambda m: m[1][: len(m[1]) // 2] + m[2], text)


def parsed(formatted_text: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted text of any number of turns."""
    out, at = [], 0
    while at < len(formatted_text):
        head = re.compile(rf"{HEAD} ((?:[^\\:]|\\.)*): ", re.S).match(formatted_text, at)
        if head is None:
            raise ValueError(f"no turn begins at {at}")
        end = next((m for m in _CONTROL.finditer(formatted_text, head.end()) if len(m[1]) % 2 == 0), None)
        if end is None or end[2] != END:
            raise ValueError(f"the turn at {at} does not end")
        out.append((re.sub(r"\\(.)", r"\1", head[1], flags=re.S), unescaped(formatted_text[head.end() : end.end(1)])))
        at = end.end() + len(LINE_END)
    return out


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_DIGEST = pa.schema([(n.split()[0], pa.string() if n.endswith("string") else pa.int64()) for n in DIGEST.split(", ")])


class _Conversation:
    def __init__(self, key):
        self.key, self.n, self.loss_chars, self.chars = key, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, segment: str, loss_start: int | None, loss_end: int | None) -> None:
        for role, text in parsed(segment):
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n += 1
        if loss_start is not None:
            learned = unescaped(segment[loss_start:loss_end])
            self.loss.update(learned.encode())
            self.loss_chars += len(learned)
        self.chars += len(segment)

    def row(self) -> tuple:
        return self.key, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest sorted segments as they come: a conversation's hashes are all that is held of it."""

    def packed(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _DIGEST.types)], schema=_DIGEST)

    now, done = None, []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("key", "segment", "loss_start", "loss_end")]
        for key, *rest in zip(*columns):
            if now is None or now.key != key:
                if now is not None:
                    done.append(now.row())
                now = _Conversation(key)
            now.add(*rest)
        if len(done) >= 1000:
            yield packed(done)
            done = []
    if now is not None:
        yield packed([*done, now.row()])


def digests(segments: DataFrame) -> DataFrame:
    """Per conversation, from its stored segments: counts and hashes of its turns and of the text under the mask."""
    order = [F.col("key").asc_nulls_first(), F.col("turn").asc_nulls_first(), "segment"]
    return segments.repartition("key").sortWithinPartitions(*order).mapInArrow(_digests, DIGEST)


def report(conversations: DataFrame, extra: DataFrame | None = None, paths: list[str] | None = None) -> DataFrame:
    rows = conversations.select("conv_id", "turn", "role", "text")
    if extra is not None:
        rows = rows.unionByName(extra)
    return digests(stored(formatted(canonical(rows, "conv_id")), [] if paths is None else paths))
