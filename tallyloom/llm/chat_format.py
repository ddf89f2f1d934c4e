"""Chat formatting: schema fingerprints select declarative mappings to canonical turns.

A record is a VARIANT of any layout: one turn, prompt and completion, instruction with input and output, a list of
messages. The layout is recognised by its fingerprint, the hash of its nested field paths without their types; the
fingerprint selects a mapping from ``LAYOUTS``. Everything is built-in functions on columns.

Turns are written in the template ``<|im_start|>role newline text <|im_end|> newline``. Inside roles and texts a backslash
is written as ``\\5c``, ``<|`` as ``\\3c|`` and, in roles, a line end as ``\\0a``, so no control string can appear there and the
template can be read back. The loss mask lists, per assistant turn, where its text lies within the turn.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import ROW, wrapped

START, END = "<|im_start|>", "<|im_end|>"
TURNS = "array<struct<role: string, text: string>>"
#: Names of roles in known layouts and what they are called here; others stay as they are.
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Layout:
    """Turns of a record: ``fixed`` pairs of a role (or ``$path`` to it) and the paths of its text, or a ``each`` list.

    ``each``: path of an array, name of the role and of the text in its elements. Texts of several paths are joined by an
    empty line; absent or empty ones are left out, and so are leading turns of role ``system`` without text.
    """

    name: str
    fields: str
    fixed: tuple[tuple[str, tuple[str, ...]], ...] = ()
    each: tuple[str, str, str] | None = None


#: ``fields`` is the canonical form of the field paths: names in order, objects in OBJECT<>, lists in ARRAY<>.
LAYOUTS = (
    Layout("turn", "OBJECT<role, text>", (("$role", ("text",)),)),
    Layout("message", "OBJECT<content, role>", (("$role", ("content",)),)),
    Layout("prompt_completion", "OBJECT<completion, prompt>", (("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("prompt_response", "OBJECT<prompt, response>", (("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("system_prompt_response", "OBJECT<prompt, response, system>", (("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("question_answer", "OBJECT<answer, question>", (("user", ("question",)), ("assistant", ("answer",)))),
    Layout("instruction", "OBJECT<instruction, output>", (("user", ("instruction",)), ("assistant", ("output",)))),
    Layout("instruction_input", "OBJECT<input, instruction, output>", (("user", ("instruction", "input")), ("assistant", ("output",)))),
    Layout("messages", "OBJECT<messages: ARRAY<OBJECT<content, role>>>", each=("messages", "role", "content")),
    Layout("conversations", "OBJECT<conversations: ARRAY<OBJECT<from, value>>>", each=("conversations", "from", "value")),
)


def field_paths(body: Column) -> Column:
    """Nested field names of a VARIANT in canonical order, without the types of the leaves."""
    leaf = r"(?:: )?\b(?:STRING|BIGINT|DECIMAL\(\d+,\s?\d+\)|DOUBLE|FLOAT|BOOLEAN|VOID|DATE|TIMESTAMP|TIMESTAMP_NTZ|BINARY|VARIANT|UUID)(?=[,>]|$)"
    return F.regexp_replace(F.schema_of_variant(body), leaf, "")


def fingerprint(body: Column) -> Column:
    """Hash of the nested field paths."""
    return F.xxhash64(field_paths(body))


def _text(body: Column, path: str) -> Column:
    return F.coalesce(F.try_variant_get(body, f"$.{path}", "string"), F.lit(""))


def _turns(layout: Layout, body: Column) -> Column:
    if layout.each:
        path, role, text = layout.each
        items = F.try_variant_get(body, f"$.{path}", f"array<struct<{role}: string, {text}: string>>")
        return F.transform(items, lambda t: F.struct(F.coalesce(t[role], F.lit("")).alias("role"), F.coalesce(t[text], F.lit("")).alias("text")))
    turns = []
    for role, paths in layout.fixed:
        named = _text(body, role[1:]) if role.startswith("$") else F.lit(role)
        text = _text(body, paths[0]) if len(paths) == 1 else F.array_join(F.filter(F.array(*[_text(body, p) for p in paths]), lambda t: t != ""), "\n\n")
        turns.append(F.struct(named.alias("role"), text.alias("text")))
    made = F.array(*turns)
    return F.filter(made, lambda t, i: (i > 0) | (t["role"] != "system") | (t["text"] != "")) if len(turns) > 2 else made


def canonical_turns(records: DataFrame, body: str = "body") -> DataFrame:
    """``records`` as ``doc`` (all columns, whatever their names) with ``layout`` and ``turns`` (role, text; nulls as empty) of the VARIANT column ``body``.

    A record of unknown layout, or null, has a null layout and no turns.
    """
    layouts = F.array(*[F.struct(F.lit(x.name).alias("layout"), F.xxhash64(F.lit(x.fields)).alias("print")) for x in LAYOUTS])
    known = records.sparkSession.range(1).select(F.inline(layouts))  # one row per layout
    held = F.col(ROW)[body]
    found = wrapped(records).join(F.broadcast(known), fingerprint(held) == F.col("print"), "left").drop("print")
    turns = F.lit(None).cast(TURNS)
    for x in LAYOUTS:
        turns = F.when(F.col("layout") == x.name, _turns(x, held).cast(TURNS)).otherwise(turns)
    names = F.create_map(*[F.lit(x) for pair in ROLE_NAMES.items() for x in pair])
    named = F.transform(F.coalesce(turns, F.array().cast(TURNS)), lambda t: F.struct(F.coalesce(names[t["role"]], t["role"]).alias("role"), t["text"].alias("text")))
    return found.withColumn("turns", named)


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\5c")), F.lit("<|"), F.lit("\\3c|"))


def unescaped(text: Column) -> Column:
    """Inverse of ``escaped``: backslashes last, as every other backslash in an escaped text starts a code."""
    return F.replace(F.replace(F.replace(text, F.lit("\\0a"), F.lit("\n")), F.lit("\\3c|"), F.lit("<|")), F.lit("\\5c"), F.lit("\\"))


def formatted(turns: DataFrame, key: str, order: str) -> DataFrame:
    """One row per value of the record column ``key``, as ``key``: ``formatted`` text and ``loss``, spans of assistant texts (turn number, start in it, length).

    ``turns`` has ``turns`` arrays as ``canonical_turns`` gives them, taken in the order of ``order``; rows with equal order by role
    and text. A conversation is one output row, so its turns meet in one task; they are collected after partial collection.
    """
    listed = turns.select(F.col(ROW)[key].alias("key"), F.col(ROW)[order].alias("order"), F.posexplode("turns").alias("pos", "turn"))
    listed = listed.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("order", "pos", "turn.role", "turn.text"))).alias("turns"))
    parts = F.transform(
        "turns",
        lambda t: F.struct(
            t["role"].alias("role"),
            F.concat(F.lit(START), F.replace(escaped(t["role"]), F.lit("\n"), F.lit("\\0a")), F.lit("\n")).alias("head"),
            escaped(t["text"]).alias("text"),
        ),
    )
    made = listed.select("key", parts.alias("parts"))
    spans = F.transform("parts", lambda p, i: F.struct(p["role"].alias("role"), i.alias("turn"), F.length(p["head"]).alias("start"), F.length(p["text"]).alias("length")))
    loss = F.transform(F.filter(spans, lambda s: s["role"] == "assistant"), lambda s: F.struct(s["turn"], s["start"], s["length"]))
    text = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["text"], F.lit(END + "\n"))), "")
    return made.select("key", text.alias("formatted"), loss.alias("loss"))


def read_back(chats: DataFrame) -> DataFrame:
    """``chats`` with ``turns`` (role, text) and ``loss_text`` as read from ``formatted`` and ``loss``."""
    split = chats.withColumn("segments", F.slice(F.split("formatted", r"<\|im_start\|>"), 2, 2147483647))
    cut = F.transform("segments", lambda s: F.struct(F.substring_index(s, "\n", 1).alias("role"), s.alias("segment")))

    def text_of(t: Column) -> Column:
        return F.substring(t["segment"], F.length(t["role"]) + 2, F.length(t["segment"]) - F.length(t["role"]) - F.lit(2 + len(END)))

    turns = F.transform(cut, lambda t: F.struct(unescaped(t["role"]).alias("role"), unescaped(text_of(t)).alias("text")))
    masked = F.transform("loss", lambda s: unescaped(F.substring(F.element_at("segments", s["turn"] + 1), s["start"] - F.lit(len(START) - 1), s["length"])))
    return split.withColumn("turns", turns).withColumn("loss_text", F.array_join(masked, "")).drop("segments")
