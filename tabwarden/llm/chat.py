"""Chat formatting: records of unlike layouts become canonical turns and then one marked text with a loss mask.

A record is JSON.  Its *nested field paths* are its keys, ``list[].key`` for the keys of all items of a list, and both under a
wrapper such as ``data``.  A declarative :class:`Layout` says which paths it must and may have, and where the turns are; it
is selected by *fingerprint*, the hash of those of the record's paths that the layout knows.  Of several layouts the one with the
most paths is taken, then the first of the registry.  Everything is a DataFrame expression.

Defined cases: a null text or role, and an item of a list without one, is empty; content in parts is the parts' texts, one after another;
roles are taken as they stand, but for layouts that declare other names for them; a system text beside a list of turns is the first turn;
nothing is dropped silently: a record that no layout fits has no turns, layout null and a reason, and the turns of a record with a text
field that its layout does not read, but another one does, have that as their reason; fields that no layout knows are no text; turns with equal positions are
ordered by role, then text, so repeated rows stay as repeated turns; very long conversations are read whole; only the two named columns
of the input are read, so others may have any name; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, pieces, starts_of

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: Strings that common chat templates give a meaning; none may stand unescaped inside a turn.
CONTROL = [START, SEP, END, "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
#: Names of roles in layouts that declare them.
OTHER_ROLES = (("human", "user"), ("prompter", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant"), ("chatgpt", "assistant"))
#: Fields that may hold the whole record.
WRAPPERS = ["data", "record", "example", "sample"]


@dataclass(frozen=True)
class Layout:
    """Where the turns of a record are: in ``fields`` of (role, path), or in the list ``items`` with a role and a text field.

    ``role_field`` and ``text_field`` without ``items`` mean that a record is one turn; ``order`` is then its position.
    A layout's other paths are required, those in ``optional`` may be there; turns of empty optional fields are left out.
    """

    name: str
    fields: tuple[tuple[str, str], ...] = ()
    optional: tuple[str, ...] = ()
    items: str | None = None
    role_field: str | None = None
    text_field: str | None = None
    order: str | None = None
    roles: tuple[tuple[str, str], ...] = ()

    @property
    def texts(self) -> list[str]:
        """The top fields that hold texts or turns."""
        return [self.items] if self.items else [p for _, p in self.fields] + [p for p in (self.text_field,) if p]

    @property
    def paths(self) -> list[str]:
        """All paths that the layout knows."""
        if self.items:
            return sorted([self.items, f"{self.items}[].{self.role_field}", f"{self.items}[].{self.text_field}", *self.optional])
        return sorted([p for _, p in self.fields] + [p for p in (self.role_field, self.text_field, self.order) if p])

    @property
    def fingerprints(self) -> list[str]:
        """The fingerprint of the required paths with each choice of optional ones."""
        fixed = [p for p in self.paths if p not in self.optional]
        some = [c for n in range(len(self.optional) + 1) for c in combinations(self.optional, n)]
        return [hashlib.sha256("\n".join(sorted([*fixed, *c])).encode()).hexdigest() for c in some]

    def turns(self, record: Column) -> Column:
        """array<struct<position, role, text>> of a record of this layout."""
        value = lambda path: F.get_json_object(record, f"$.{path}")
        turn = lambda at, role, text: F.struct(at.cast("bigint").alias("position"), F.coalesce(self.canonical(role), F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
        if self.items:
            listed = F.from_json(value(self.items), f"array<struct<`{self.role_field}`:string,`{self.text_field}`:variant>>")
            own = F.transform(listed, lambda x, i: turn(i, x[self.role_field], said(x[self.text_field])))
            if not self.optional:
                return own
            first = F.filter(F.array(turn(F.lit(-1), F.lit("system"), value("system"))), lambda t: t["text"] != "")
            return F.concat(first, own)
        if self.role_field:
            return F.array(turn(value(self.order), value(self.role_field), value(self.text_field)))
        every = F.array(*[F.struct(turn(F.lit(i), F.lit(role), value(path)).alias("turn"), F.lit(path in self.optional).alias("may")) for i, (role, path) in enumerate(self.fields)])
        return F.transform(F.filter(every, lambda t: ~t["may"] | (t["turn"]["text"] != "")), lambda t: t["turn"])

    def canonical(self, role: Column) -> Column:
        if not self.roles:
            return role
        return F.coalesce(F.create_map(*[F.lit(x) for pair in self.roles for x in pair])[role], role)


def said(content: Column) -> Column:
    """The text of a value: itself, or the texts of its parts."""
    parts = F.try_variant_get(content, "$", "array<struct<text:string>>")
    joined = F.array_join(F.transform(parts, lambda p: F.coalesce(p["text"], F.lit(""))), "")
    return F.when(F.schema_of_variant(content).startswith("ARRAY"), joined).otherwise(F.try_variant_get(content, "$", "string"))


def _flat(name: str, *fields: tuple[str, str], optional: tuple[str, ...] = ("system",)) -> Layout:
    """A record with a field for each turn, and perhaps more."""
    first = (("system", "system"),) if "system" in optional else ()
    return Layout(name, fields=first + fields, optional=optional)


LAYOUTS = [
    Layout("turn rows", role_field="role", text_field="text", order="turn"),
    Layout("messages", items="messages", role_field="role", text_field="content", optional=("system",)),
    Layout("share", items="conversations", role_field="from", text_field="value", optional=("system",), roles=OTHER_ROLES),
    Layout("dialogue", items="turns", role_field="speaker", text_field="text", optional=("system",), roles=OTHER_ROLES),
    _flat("prompt and response", ("user", "prompt"), ("user", "input"), ("assistant", "response"), optional=("system", "input")),
    _flat("prompt and completion", ("user", "prompt"), ("assistant", "completion")),
    _flat("instruction", ("user", "instruction"), ("user", "input"), ("assistant", "output"), optional=("system", "input")),
    _flat("question", ("user", "context"), ("user", "question"), ("assistant", "answer"), optional=("system", "context")),
]


def unwrapped(record: Column, layouts: list[Layout] = LAYOUTS) -> Column:
    """The record itself, or what its wrapper holds if it has no field of a layout of its own."""
    tops = F.array(*[F.lit(p) for p in sorted({p.split("[")[0] for x in layouts for p in x.paths})])
    inner = F.coalesce(*[F.get_json_object(record, f"$.{w}") for w in WRAPPERS])
    bare = ~F.coalesce(F.arrays_overlap(F.json_object_keys(record), tops), F.lit(True))
    return F.when(bare & F.json_object_keys(inner).isNotNull(), inner).otherwise(record)


def field_paths(record: Column, layouts: list[Layout] = LAYOUTS) -> Column:
    """A record's keys, and ``list[].key`` for the keys of all items of the lists that layouts have; null if it is no object."""
    lists = sorted({x.items for x in layouts if x.items})
    keys = F.json_object_keys(record)

    def inside(a: str) -> Column:
        each = F.from_json(F.get_json_object(record, f"$.{a}"), "array<map<string,variant>>")
        names = F.array_distinct(F.flatten(F.transform(each, lambda m: F.coalesce(F.map_keys(m), F.array().cast("array<string>")))))
        return F.when(F.array_contains(keys, a), F.coalesce(F.transform(names, lambda k: F.concat(F.lit(f"{a}[]."), k)), F.array().cast("array<string>"))).otherwise(F.array().cast("array<string>"))

    return F.concat(keys, *map(inside, lists)) if lists else keys


def fingerprint(paths: Column, layout: Layout) -> Column:
    """The hash of those of a record's paths that a layout knows."""
    return F.sha2(F.array_join(F.sort_array(F.array_intersect(paths, F.array(*map(F.lit, layout.paths)))), "\n"), 256)


def select_layout(paths: Column, layouts: list[Layout] = LAYOUTS) -> Column:
    """The place in the registry of the layout that fits with the most paths; null if none does."""
    fits = [F.when(fingerprint(paths, x).isin(x.fingerprints), F.struct(F.size(F.array_intersect(paths, F.array(*map(F.lit, x.paths)))).alias("n"), F.lit(-i).alias("first"))) for i, x in enumerate(layouts)]
    return -F.array_max(F.array_compact(F.array(*fits)))["first"]


def canonical_turns(records: DataFrame, id_col: str, record_col: str, layouts: list[Layout] = LAYOUTS) -> DataFrame:
    """A row (id, layout, reason, position, role, text) per turn; a record without turns keeps one row without a position."""
    df = records.select(F.col(id_col).alias("id"), unwrapped(F.col(record_col), layouts).alias("record"), F.col(record_col).isNull().alias("none"))
    texts = sorted({t for x in layouts for t in [*x.texts, *x.optional]})
    told = lambda p: F.struct(p.isNotNull().alias("object"), select_layout(p, layouts).alias("layout"), F.array_intersect(p, F.array(*map(F.lit, texts))).alias("texts"))
    df = df.withColumn("place", let(field_paths(F.col("record"), layouts), told))
    place, turns, unread, lists = F.col("place.layout"), F.lit(None), F.lit(None), F.lit(False)
    for i, x in enumerate(layouts):
        turns = F.when(place == i, x.turns(F.col("record"))).otherwise(turns)
        unread = F.when(place == i, F.array_except("place.texts", F.array(*map(F.lit, [*x.texts, *x.optional])))).otherwise(unread)
        if x.items:
            lists = lists | F.coalesce(F.get_json_object("record", f"$.{x.items}") == "[]", F.lit(False))
    name = F.get(F.array(*[F.lit(x.name) for x in layouts]), place)
    df = df.select("id", name.alias("layout"), F.col("place.object").alias("object"), "none", turns.alias("turns"), unread.alias("unread"), lists.alias("empty"))
    reason = F.when(F.col("none"), "no record").when(~F.col("object"), "no JSON object").when(F.col("layout").isNull() & F.col("empty"), "no turns").when(F.col("layout").isNull(), "no layout has its fields")
    reason = reason.when(F.coalesce(F.size("turns"), F.lit(0)) <= 0, "no turns").when(F.size("unread") > 0, F.concat(F.lit("texts that its layout does not read: "), F.array_join("unread", ", ")))
    return df.select("id", "layout", reason.alias("reason"), F.explode_outer("turns").alias("t")).select("id", "layout", "reason", "t.position", "t.role", "t.text")


def escape(text: Column) -> Column:
    """Double each backslash and put one after the first character of each control string."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for s in CONTROL:
        text = F.replace(text, F.lit(s), F.lit(f"{s[0]}\\{s[1:]}"))
    return text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_chats(turns: DataFrame, learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(id, formatted, loss): the marked text, and the code-point spans (start, length) a model learns from.

    A conversation is one value, so its turns meet in one task; conversations are dealt out by id.
    """
    piece = F.struct("position", F.col("role").alias("by"), F.col("text").alias("said"), F.concat(F.lit(START), escape(F.col("role")), F.lit(SEP)).alias("head"), escape(F.col("text")).alias("body"))
    df = turns.groupBy("id").agg(F.sort_array(F.collect_list(F.when(F.col("role").isNotNull(), piece))).alias("p"))
    tail = f"{END}\n"
    df = df.withColumn("at", starts_of(F.transform("p", lambda x: F.length(x["head"]) + F.length(x["body"]) + len(tail))))
    spans = F.transform("p", lambda x, i: F.struct(x["by"].alias("by"), (F.col("at")[i] + F.length(x["head"])).alias("start"), F.length(x["body"]).cast("bigint").alias("length")))
    return df.select(
        "id",
        F.array_join(F.transform("p", lambda x: F.concat(x["head"], x["body"], F.lit(tail))), "").alias("formatted"),
        F.transform(F.filter(spans, lambda x: x["by"].isin(*learn)), lambda x: F.struct(x["start"], x["length"])).alias("loss"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) that a formatted text was made from."""
    parts = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda x: x != "")
    return F.transform(parts, lambda x: F.struct(unescape(F.substring(F.substring_index(x, SEP, 1), len(START) + 1, 2**31 - 1)).alias("role"), unescape(F.substring_index(x, SEP, -1)).alias("text")))


def read_loss(formatted: Column, loss: Column) -> Column:
    """The unescaped texts under the loss mask, in order, with nothing between."""
    ends = F.transform(loss, lambda s: F.struct(s["start"].alias("start"), (s["start"] + s["length"]).alias("end")))
    return F.array_join(F.transform(pieces(formatted, ends), unescape), "")
