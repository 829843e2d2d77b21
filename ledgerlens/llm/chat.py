"""Chat formatting: records of many layouts become canonical turns and one marked text.

A record is JSON. Its layout is the set of its nested field paths (``messages[].role``),
taken from the variant's schema without the types; the hash of that text is the
fingerprint that selects a declarative mapping. A mapping says where turns come
from: a fixed list of (role, path) pairs, or an array with the paths of role and
text in each element. Roles go through one table of synonyms.

Canonical turns are then put together per conversation as

    <|im_start|>role\\ntext<|im_end|>\\n

with ``&`` and ``<|`` escaped inside roles and texts (and line ends inside roles),
which ``unescape`` reverses. The loss mask is run lengths: for each turn how many
code points are skipped and how many follow that count (an assistant's text).

All of it is DataFrame work. Null texts and missing fields count as empty, null
roles as ``user`` (as empty in turn rows). Turns are ordered by turn number, place in the record, role and text (nulls
first); repeated rows are turns of their own. Rows without a conversation id form
one conversation with a null id. Rows whose fields already are columns are mapped
by ``column_turns`` without JSON, whatever the length of their texts. Records of
unknown layout, broken JSON or a string above 20,000,000 characters (Spark's JSON
parsers give null there) come back with a null mapping from ``canonical_turns``
(``unmapped`` lists them); ``format_turns`` fails on them, none is dropped without a
word. Struct columns of several layouts go through the same fingerprints (``struct_turns``). Other columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END = "<|im_start|>", "<|im_end|>"
TURN = "array<struct<at:int,role:string,text:string>>"


@dataclass(frozen=True)
class Layout:
    """Field paths of a record and where its turns are.

    ``fixed``: (role, JSON path) pairs in order; empty texts of ``optional`` paths make no turn.
    ``array``: (path of the array, field of the role, field of the text) instead; an
    empty path is the record itself as one turn, with its role as it is.
    """

    name: str
    paths: tuple[str, ...]
    fixed: tuple[tuple[str, str], ...] = ()
    optional: tuple[str, ...] = ()
    array: tuple[str, str, str] | None = None


LAYOUTS = (
    Layout("turn_row", ("role", "text"), array=("", "role", "text")),
    Layout("prompt_completion", ("completion", "prompt"), (("user", "prompt"), ("assistant", "completion"))),
    Layout("prompt_response", ("prompt", "response"), (("user", "prompt"), ("assistant", "response"))),
    Layout("system_prompt_response", ("prompt", "response", "system"),
           (("system", "system"), ("user", "prompt"), ("assistant", "response")), ("system",)),
    Layout("instruction_output", ("instruction", "output"), (("user", "instruction"), ("assistant", "output"))),
    Layout("instruction_input_output", ("input", "instruction", "output"),
           (("user", "instruction"), ("user", "input"), ("assistant", "output")), ("input",)),
    Layout("question_answer", ("answer", "question"), (("user", "question"), ("assistant", "answer"))),
    Layout("messages", ("messages[].content", "messages[].role"), array=("messages", "role", "content")),
    Layout("conversations", ("conversations[].from", "conversations[].value"), array=("conversations", "from", "value")),
    Layout("dialog", ("dialog[].speaker", "dialog[].text"), array=("dialog", "speaker", "text")),
)
ROLES = {"human": "user", "prompter": "user", "customer": "user", "gpt": "assistant", "bot": "assistant",
         "model": "assistant", "chatgpt": "assistant", "ai": "assistant"}


def layout_text(record: Column) -> Column:
    """The nested field names of a JSON record without their types, e.g. ``{messages:[{content,role}]}``."""
    schema = F.schema_of_variant(F.try_parse_json(record))
    # The words that variant schemas use for objects, arrays and scalar types.
    bare = F.regexp_replace(schema, r": (STRING|BIGINT|DOUBLE|BOOLEAN|VOID|VARIANT|DECIMAL\(\d+,\s?\d+\))(?=[,>])", "")
    return F.replace(F.replace(F.replace(bare, F.lit("OBJECT<"), F.lit("{")), F.lit("ARRAY<"), F.lit("[")), F.lit(": "),
                     F.lit(":"))


def expected_text(paths: tuple[str, ...]) -> str:
    """``layout_text`` of a record that has exactly these paths (one level of arrays)."""
    top: dict[str, list[str]] = {}
    for p in paths:
        head, _, rest = p.partition("[].")
        top.setdefault(head, []).extend([rest] if rest else [])
    parts = [f"{k}:[{{{', '.join(sorted(v))}>>" if v else k for k, v in sorted(top.items())]
    return "{" + ", ".join(parts) + ">"


def fingerprint(record: Column) -> Column:
    """64-bit hash of a record's nested field paths."""
    return F.xxhash64(layout_text(record))


def _role(role: Column) -> Column:
    low = F.lower(F.trim(F.coalesce(role, F.lit("user"))))
    table = F.create_map(*[F.lit(x) for kv in ROLES.items() for x in kv])
    return F.coalesce(F.element_at(table, low), F.when(low == "", F.lit("user")).otherwise(low))


def _turn(at: Column, role: Column, text: Column) -> Column:
    return F.struct(at.cast("int").alias("at"), role.alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _turns(layout: Layout, record: Column) -> Column:
    if layout.array is None:
        items = [_turn(F.lit(i), F.lit(role), F.get_json_object(record, f"$.{path}"))
                 for i, (role, path) in enumerate(layout.fixed)]
        must = [i for i, (_, path) in enumerate(layout.fixed) if path not in layout.optional]
        if len(must) == len(items):
            return F.array(*items)
        return F.filter(F.array(*items), lambda t: t["at"].isin(must) | (t["text"] != ""))
    path, role, text = layout.array
    fields = f"{role} string, {text} string"
    if not path:
        one = F.from_json(record, fields)
        return F.array(_turn(F.lit(0), F.coalesce(one[role], F.lit("")), one[text]))
    parsed = F.from_json(record, f"{path} array<struct<{role}:string,{text}:string>>")[path]
    return F.transform(parsed, lambda x, i: _turn(i, _role(x[role]), x[text]))


def canonical_turns(records: DataFrame, *, record_col: str, conv_col: str, turn_col: str,
                    layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """(conv, turn, at, role, text, layout): one row per turn; ``turn`` and ``at`` order them.

    Records that no mapping fits give one row with null layout, role and text.
    """
    src = records.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(record_col).alias("record"))
    src = src.withColumn("print", fingerprint(F.col("record")))
    chosen, turns = F.lit(None).cast("string"), F.lit(None).cast(TURN)
    for lay in reversed(layouts):
        hit = F.col("print") == F.xxhash64(F.lit(expected_text(lay.paths)))
        chosen = F.when(hit, F.lit(lay.name)).otherwise(chosen)
        turns = F.when(hit, _turns(lay, F.col("record"))).otherwise(turns)
    out = src.select("conv", "turn", chosen.alias("layout"), F.explode_outer(turns.cast(TURN)).alias("t"))
    return out.select("conv", "turn", F.col("t.at").alias("at"), F.col("t.role").alias("role"),
                      F.col("t.text").alias("text"), "layout")


def column_turns(rows: DataFrame, *, record_cols: tuple[str, ...], conv_col: str, turn_col: str,
                 layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``canonical_turns`` of rows whose fields are the columns ``record_cols``; no JSON is made or parsed.

    The layout is the one with just these names as paths; without one it is a ValueError.
    """
    names = tuple(sorted(record_cols))
    layout = next((x for x in layouts if tuple(sorted(x.paths)) == names), None)
    if layout is None:
        raise ValueError(f"no mapping fits the columns {', '.join(names)}")
    field = {n: F.col(n).cast("string") for n in names}
    if layout.array is None:
        items = F.array(*[_turn(F.lit(i), F.lit(role), field[path]) for i, (role, path) in enumerate(layout.fixed)])
        must = [i for i, (_, path) in enumerate(layout.fixed) if path not in layout.optional]
        turns = F.filter(items, lambda t: t["at"].isin(must) | (t["text"] != ""))
    else:
        _, role, text = layout.array
        turns = F.array(_turn(F.lit(0), F.coalesce(field[role], F.lit("")), field[text]))
    out = rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.inline(turns.cast(TURN)))
    return out.select("conv", "turn", "at", "role", "text", F.lit(layout.name).alias("layout"))


def _emptied(value: Column, kind: T.DataType) -> Column:
    """A value's shape without its contents: texts are empty, arrays have one element at most."""
    if isinstance(kind, T.StructType):
        return F.when(value.isNotNull(), F.struct(*[_emptied(value[f.name], f.dataType).alias(f.name) for f in kind.fields]))
    if isinstance(kind, T.ArrayType):
        return F.transform(F.slice(value, 1, 1), lambda x: _emptied(x, kind.elementType))
    return F.lit("")


def _has(kind: T.DataType, layout: Layout) -> bool:
    """Whether a struct type has all fields of a layout."""
    names = {f.name: f.dataType for f in kind.fields} if isinstance(kind, T.StructType) else {}
    if layout.array is None:
        return all(p in names for _, p in layout.fixed)
    path, role, text = layout.array
    if path:
        inner = names[path].elementType if isinstance(names.get(path), T.ArrayType) else None
        names = {f.name: f.dataType for f in inner.fields} if isinstance(inner, T.StructType) else {}
    return role in names and text in names


def _struct_turns(layout: Layout, record: Column) -> Column:
    """``_turns`` of a struct column."""
    if layout.array is None:
        items = F.array(*[_turn(F.lit(i), F.lit(role), record[path].cast("string")) for i, (role, path) in enumerate(layout.fixed)])
        must = [i for i, (_, path) in enumerate(layout.fixed) if path not in layout.optional]
        return F.filter(items, lambda t: t["at"].isin(must) | (t["text"] != ""))
    path, role, text = layout.array
    if not path:
        return F.array(_turn(F.lit(0), F.coalesce(record[role].cast("string"), F.lit("")), record[text].cast("string")))
    return F.transform(record[path], lambda x, i: _turn(i, _role(x[role].cast("string")), x[text].cast("string")))


def struct_turns(rows: DataFrame, *, record_cols: tuple[str, ...], conv_col: str, turn_col: str,
                 layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``canonical_turns`` of rows whose record is one of the struct columns ``record_cols`` (the first that is not null).

    Each row's fingerprint is taken of its record's shape, in which every text is empty, so that texts of any length
    stay out of the JSON; the fingerprint selects the mapping, which reads the texts from the struct.
    """
    kinds = {c: rows.schema[c].dataType for c in record_cols}
    shape = F.coalesce(*[F.when(F.col(c).isNotNull(), F.to_json(_emptied(F.col(c), kinds[c]), {"ignoreNullFields": "false"}))
                         for c in record_cols])
    src = rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
                      *[F.col(c).alias(f"r{i}") for i, c in enumerate(record_cols)], fingerprint(shape).alias("print"))
    chosen, turns = F.lit(None).cast("string"), F.lit(None).cast(TURN)
    for lay in reversed(layouts):
        for i, c in reversed(list(enumerate(record_cols))):
            if _has(kinds[c], lay):
                first = F.col(f"r{i}").isNotNull()
                for j in range(i):
                    first = first & F.col(f"r{j}").isNull()
                hit = first & (F.col("print") == F.xxhash64(F.lit(expected_text(lay.paths))))
                chosen = F.when(hit, F.lit(lay.name)).otherwise(chosen)
                turns = F.when(hit, _struct_turns(lay, F.col(f"r{i}"))).otherwise(turns)
    out = src.select("conv", "turn", chosen.alias("layout"), F.explode_outer(turns.cast(TURN)).alias("t"))
    return out.select("conv", "turn", F.col("t.at").alias("at"), F.col("t.role").alias("role"),
                      F.col("t.text").alias("text"), "layout")


def unmapped(turns: DataFrame) -> DataFrame:
    """Rows of ``canonical_turns`` whose record no mapping fits."""
    return turns.where("layout IS NULL")


def escape(text: Column, *, role: bool = False) -> Column:
    """Reversible: no ``<|`` is left (and no line end in a role)."""
    out = F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))
    return F.replace(out, F.lit("\n"), F.lit("&nl;")) if role else out


def unescape(text: Column) -> Column:
    out = F.replace(F.replace(text, F.lit("&nl;"), F.lit("\n")), F.lit("&lt;"), F.lit("<"))
    return F.replace(out, F.lit("&amp;"), F.lit("&"))


def format_turns(turns: DataFrame, *, assistant: str = "assistant") -> DataFrame:
    """(conv, formatted, loss_runs): one row per conversation; a record that no mapping fits is an error.

    ``loss_runs``: for each turn (skip, take) in code points; text outside ``take`` is masked.
    """
    lost = F.raise_error(F.concat(F.lit("a record fits no mapping, conversation "),
                                  F.coalesce(F.col("conv").cast("string"), F.lit("null")))).cast("boolean")
    t = turns.where(F.when(F.col("layout").isNotNull(), True).otherwise(lost)).select(
        "conv", "turn", "at", escape(F.col("role"), role=True).alias("role"), escape(F.col("text")).alias("text"))
    # The aggregate's partial lists are made before the shuffle, so a hot conversation's rows are put together early.
    got = t.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("turn", "at", "role", "text"))).alias("t"))
    piece = F.transform("t", lambda x: F.concat(F.lit(START), x["role"], F.lit("\n"), x["text"], F.lit(END + "\n")))
    runs = F.transform("t", lambda x, i: F.struct(
        (F.length(x["role"]) + F.lit(len(START) + 1) + F.when(i > 0, len(END) + 1).otherwise(0)
         + F.when(x["role"] == assistant, 0).otherwise(F.length(x["text"]))).alias("skip"),
        F.when(x["role"] == assistant, F.length(x["text"])).otherwise(0).alias("take")))
    return got.select("conv", F.concat_ws("", piece).alias("formatted"), runs.alias("loss_runs"))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv, turns, loss_texts): turns parsed from the text, and the unescaped texts under the mask.

    The marks can't occur inside roles or texts, so splitting at them finds the turns.
    A turn's text is under the mask where its run's ``take`` covers it; a run that covers part of a turn is an error.
    """
    parts = F.slice(F.split("formatted", r"<\|im_start\|>"), 2, 1 << 30)
    role = F.transform(parts, lambda p: F.struct(F.substring_index(p, "\n", 1).alias("role"), p.alias("p")))
    body = F.transform(role, lambda c: F.struct(c["role"].alias("role"), F.substring(
        c["p"], F.length(c["role"]) + 2, F.length(c["p"]) - F.length(c["role"]) - 2 - len(END)).alias("text")))
    out = formatted.select("conv", "formatted", "loss_runs", body.alias("b"))
    turns = F.transform("b", lambda x: F.struct(unescape(x["role"]).alias("role"), unescape(x["text"]).alias("text")))
    odd = F.raise_error(F.concat(F.lit("a loss run covers no whole turn, conversation "),
                                 F.coalesce(F.col("conv").cast("string"), F.lit("null")))).cast("boolean")
    lost = F.filter(F.arrays_zip("b", "loss_runs"), lambda z: F.when(z["loss_runs"]["take"] == 0, False).when(
        z["loss_runs"]["take"] == F.length(z["b"]["text"]), True).otherwise(odd))
    return out.select("conv", "formatted", turns.alias("turns"),
                      F.transform(lost, lambda z: unescape(z["b"]["text"])).alias("loss_texts"))
