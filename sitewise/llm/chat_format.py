"""Chat records of many layouts, formatted by one template.

A record is a JSON document.  Its schema fingerprint is the hash of its
nested field paths (names and nesting, without the types of the leaves, so a
null and a text have one path).  The fingerprint selects a declarative
:class:`Layout`, which says where the turns stand and how their roles are
named; nothing else about a layout is code.  A record becomes canonical turns
(role, text), and a template writes them as one string in which control
strings mark the turns and never occur inside a role or a text: a backslash
is put after the first character of each one found there, and backslashes are
doubled, which :func:`unescaped` undoes exactly.  The loss mask is a list of
spans, counted in code points, that cover the texts of the trained roles.

Everything is a Spark expression over one row; rows are never combined.
A record that is null, not JSON or of an unknown fingerprint comes back with
a null layout and no turns (``census`` counts them by schema).  Null texts
and roles are empty; a record without turns is formatted as the bare frame;
rows that repeat a key are formatted each.  A record stays under Spark's size
limit of a variant (128 MB), larger ones count as not JSON.  Columns other
than the key and the record are left out and may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from itertools import chain, combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load, materialize

TURN = "struct<role:string,text:string>"
DEPTH = 6  # of nesting that paths writes out in full; deeper ones have another, equally fixed spelling


@dataclass(frozen=True)
class Layout:
    """Where a layout keeps its turns.

    ``turns``: (role, field) of single turns in order, absent fields giving no
    turn.  ``listed``: the field of an array of turns, whose items have
    ``role_field`` and ``text_field``.  ``optional``: fields that may be
    missing, of the record or (``listed``) of its items.  ``roles``: names
    of roles that mean another.
    """

    name: str
    turns: tuple[tuple[str, str], ...] = ()
    listed: str = ""
    role_field: str = ""
    text_field: str = ""
    optional: tuple[str, ...] = ()
    item_optional: tuple[str, ...] = ()
    roles: dict[str, str] = field(default_factory=dict)

    def schemas(self) -> list[str]:
        """Path schemas of all records of the layout, see :func:`paths`."""
        def some(names: Sequence[str]):
            return chain.from_iterable(combinations(names, k) for k in range(len(names) + 1))

        out = []
        for extra in some(self.optional):
            own = [f for _, f in self.turns if f not in self.optional]
            if not self.listed:
                out.append(_object([(f, "") for f in [*own, *extra]]))
                continue
            out.append(_object([(self.listed, "[]"), *[(f, "") for f in extra]]))  # without any turn
            for more in some(self.item_optional):
                item = _object([(f, "") for f in (self.role_field, self.text_field, *more)])
                out.append(_object([(self.listed, f"[{item}]"), *[(f, "") for f in extra]]))
        return out


def _object(fields: list[tuple[str, str]]) -> str:
    return "{" + ",".join(f"{name}{inner}" for name, inner in sorted(fields)) + "}"


LAYOUTS = (
    Layout("prompt", turns=(("system", "system"), ("user", "prompt"), ("assistant", "completion")), optional=("system",)),
    Layout("question", turns=(("user", "question"), ("assistant", "answer"))),
    Layout("instruction", turns=(("system", "system"), ("user", "instruction"), ("user", "input"), ("assistant", "output")), optional=("system", "input")),
    Layout("messages", listed="messages", role_field="role", text_field="content", optional=("id", "source"), item_optional=("name",)),
    Layout("conversations", listed="conversations", role_field="from", text_field="value", optional=("id", "source"), item_optional=("weight",),
           roles={"human": "user", "gpt": "assistant"}),
)


def paths(record: Column) -> Column:
    """The nested field paths of a variant, in one string: fields by name, in
    braces; items of an array in brackets, a star for leaves; nothing for
    other leaves."""
    leaf = r"(?!OBJECT<|ARRAY<)[A-Z_]+(\(\d+,\d+\))?"
    out = F.schema_of_variant(record)
    out = F.regexp_replace(out, f": {leaf}(?=[,>])", "")
    out = F.regexp_replace(out, "ARRAY<VOID>", "⟦⟧")
    out = F.regexp_replace(out, f"ARRAY<{leaf}>", "⟦*⟧")
    for old, new in ((r"(: )?OBJECT<", "{"), (r"(: )?ARRAY<", "["), (": ⟦", "⟦"), (", ", ",")):
        out = F.regexp_replace(out, old, new)
    for _ in range(DEPTH):  # closes the brackets, from the innermost outwards
        out = F.regexp_replace(out, r"\[([^\[{<>]*)>", "⟦$1⟧")
        out = F.regexp_replace(out, r"\{([^\[{<>]*)>", "⟨$1⟩")
    return F.translate(out, "⟨⟩⟦⟧`", "{}[]")


def fingerprint(record: Column) -> Column:
    return F.sha2(paths(record), 256)


def layout_table(spark: SparkSession, layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """(fingerprint, layout): one row a schema that a layout allows."""
    rows = [(lay.name, s) for lay in layouts for s in lay.schemas()]
    return spark.createDataFrame(rows, "layout string, schema string").select(F.sha2("schema", 256).alias("fingerprint"), "layout", "schema")


def _turn(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _named(role: Column, roles: dict[str, str]) -> Column:
    for known, means in roles.items():
        role = F.when(role == known, F.lit(means)).otherwise(role)
    return role


def canonical(record: Column, layout: Layout) -> Column:
    """Turns of a record that has ``layout``."""
    if layout.listed:
        item = f"array<struct<`{layout.role_field}`:string,`{layout.text_field}`:string>>"
        items = F.try_variant_get(record, f"$.{layout.listed}", item)
        return F.transform(items, lambda x: _turn(_named(x[layout.role_field], layout.roles), x[layout.text_field]))
    turns = [F.when(F.try_variant_get(record, f"$.{f}", "variant").isNotNull(), _turn(F.lit(role), F.try_variant_get(record, f"$.{f}", "string"))) for role, f in layout.turns]
    return F.filter(F.array(*turns), lambda t: t.isNotNull())


@dataclass(frozen=True)
class Template:
    """Control strings of two or more characters, none of them with a
    backslash or inside another from its second character on."""

    begin: str = "<s>"
    open: str = "[INST]"
    text: str = "[TEXT]"
    close: str = "[/INST]"
    end: str = "</s>"

    def controls(self) -> list[str]:
        return [self.begin, self.open, self.text, self.close, self.end]

    def escaped(self, text: Column) -> Column:
        found = "|".join(re.escape(c) for c in self.controls())
        text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
        return F.regexp_replace(text, f"(?s)(?={found})(.)", r"$1\\")


TEMPLATE = Template()


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


BLOCK = 256


def _running(numbers: Column) -> Column:
    """Sums of the numbers before each one and, last, of all of them: inside
    blocks first, so a long list costs BLOCK steps a number and no more."""
    def sums(xs: Column) -> Column:
        return F.aggregate(xs, F.array(F.lit(0).cast("long")), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))

    def placed(inner: Column) -> Column:
        return _let(sums(F.transform(inner, lambda p: F.element_at(p, -1))), lambda ahead: F.concat(
            F.flatten(F.transform(inner, lambda p, i: F.transform(F.slice(p, 1, F.size(p) - 1), lambda x: x + F.get(ahead, i)))), F.array(F.element_at(ahead, -1))))

    starts = F.when(F.size(numbers) > 0, F.sequence(F.lit(1), F.size(numbers), F.lit(BLOCK))).otherwise(F.array().cast("array<int>"))
    return _let(F.transform(starts, lambda s: sums(F.slice(numbers, s, F.lit(BLOCK)))), placed)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once a row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def formatted(turns: Column, trained: Sequence[str], template: Template = TEMPLATE) -> Column:
    """struct(formatted, loss_spans) of canonical turns; a span is struct(start, length), start from 1."""
    parts = F.transform(turns, lambda t: F.struct(
        F.concat(F.lit(template.open), template.escaped(t["role"]), F.lit(template.text)).alias("head"),
        template.escaped(t["text"]).alias("body"), t["role"].isin(*trained).alias("trained")))
    frame = len(template.begin) + 1

    def write(p: Column) -> Column:
        sizes = F.transform(p, lambda x: (F.length(x["head"]) + F.length(x["body"]) + len(template.close)).cast("long"))
        spans = _let(_let(sizes, _running), lambda before: F.transform(p, lambda x, i: F.struct(
            (F.get(before, i) + F.length(x["head"]) + frame).alias("start"), F.length(x["body"]).cast("long").alias("length"), x["trained"].alias("trained"))))
        text = F.concat(F.lit(template.begin), F.array_join(F.transform(p, lambda x: F.concat(x["head"], x["body"], F.lit(template.close))), ""), F.lit(template.end))
        kept = F.transform(F.filter(spans, lambda s: s["trained"]), lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length")))
        return F.struct(text.alias("formatted"), kept.alias("loss_spans"))

    return _let(parts, write)


def format_records(records: DataFrame, key: str, record: str, layouts: Sequence[Layout] = LAYOUTS, trained: Sequence[str] = ("assistant",),
                   template: Template = TEMPLATE) -> DataFrame:
    """key, schema, fingerprint, layout, formatted and loss_spans, one row per record."""
    rows = records.select(F.col(key).alias("key"), F.try_parse_json(F.col(record)).alias("record"))
    rows = rows.withColumn("schema", paths(F.col("record"))).withColumn("fingerprint", F.sha2("schema", 256))
    known = layout_table(records.sparkSession, layouts).select(F.col("fingerprint").alias("known"), "layout")
    # one row a schema that the layouts allow, whatever the data
    rows = rows.join(F.broadcast(known), F.col("fingerprint") == F.col("known"), "left")
    turns = F.lit(None).cast(f"array<{TURN}>")
    for lay in layouts:
        turns = F.when(F.col("layout") == lay.name, canonical(F.col("record"), lay)).otherwise(turns)
    out = formatted(turns, trained, template)
    out = F.when(F.col("layout").isNotNull(), out)
    return rows.select("key", "schema", "fingerprint", "layout", out.alias("out")).select("key", "schema", "fingerprint", "layout", "out.formatted", "out.loss_spans")


def census(formatted_records: DataFrame) -> DataFrame:
    """Records by schema and layout; a null layout is one to declare."""
    return formatted_records.groupBy("schema", "fingerprint", "layout").agg(F.count(F.lit(1)).alias("n"))


def read_turns(text: Column, template: Template = TEMPLATE) -> Column:
    """Canonical turns read back from a formatted string."""
    inner = F.substring(text, len(template.begin) + 1, F.length(text) - len(template.begin) - len(template.end))
    whole = f"(?s){re.escape(template.open)}(.*?){re.escape(template.text)}(.*?){re.escape(template.close)}"
    roles, texts = (F.regexp_extract_all(inner, F.lit(whole), F.lit(g)) for g in (1, 2))
    return F.zip_with(roles, texts, lambda r, t: F.struct(unescaped(r).alias("role"), unescaped(t).alias("text")))


def read_loss(text: Column, spans: Column) -> Column:
    """What the loss mask covers, unescaped, without anything between.  Spans
    are cut from the stretch of BLOCK spans they stand in: to find a place in
    a string Spark counts from its start."""
    starts = F.when(F.size(spans) > 0, F.sequence(F.lit(1), F.size(spans), F.lit(BLOCK))).otherwise(F.array().cast("array<int>"))

    def cut(block: Column) -> Column:
        base, last = F.get(block, F.lit(0))["start"], F.element_at(block, -1)
        stretch = F.substring(text, base.cast("int"), (last["start"] + last["length"] - base).cast("int"))
        return _let(stretch, lambda whole: F.array_join(F.transform(block, lambda s: unescaped(F.substring(whole, (s["start"] - base + 1).cast("int"), s["length"].cast("int")))), ""))

    return F.array_join(F.transform(F.transform(starts, lambda i: F.slice(spans, i, F.lit(BLOCK))), cut), "")


COLLIDING = "</s>[INST] ok [/INST]"


def records_of(turn_rows: DataFrame) -> DataFrame:
    """(conv_id, record): a JSON record per conversation, in the layout that
    its turns allow; of several the id picks one.

    The rows of a conversation are one record, as in any chat corpus; they
    are ordered by turn, rows of one turn by role and text.
    """
    rows = turn_rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(
        F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).alias("t"))
    rows = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    role = F.array_join(F.transform("ts", lambda t: t["role"]), "\n")
    text = [F.get(F.col("ts"), i)["text"] for i in range(3)]
    pick = F.pmod(F.coalesce(F.col("conv_id"), F.lit(0)), F.lit(4))
    back = {means: name for name, means in next(x for x in LAYOUTS if x.name == "conversations").roles.items()}
    exact = F.forall("ts", lambda t: ~t["role"].isin(*back.values()))  # a role of the other naming would not come back
    messages = F.to_json(F.struct(F.transform("ts", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content"))).alias("messages")))
    shared = F.to_json(F.struct(F.col("conv_id").alias("id"), F.transform("ts", lambda t: F.struct(_named(t["role"], back).alias("from"), t["text"].alias("value"))).alias("conversations")))
    pair, three = role == "user\nassistant", role == "system\nuser\nassistant"
    record = (F.when(pair & (pick == 0), F.to_json(F.struct(text[0].alias("prompt"), text[1].alias("completion"))))
              .when(pair & (pick == 1), F.to_json(F.struct(text[0].alias("question"), text[1].alias("answer"))))
              .when(pair & (pick == 2), F.to_json(F.struct(text[0].alias("instruction"), text[1].alias("output"))))
              .when(three & (pick == 0), F.to_json(F.struct(text[0].alias("system"), text[1].alias("prompt"), text[2].alias("completion"))))
              .when(three & (pick == 1), F.to_json(F.struct(text[0].alias("system"), text[1].alias("instruction"), text[2].alias("output"))))
              .when(exact & (pick >= 2), shared).otherwise(messages))
    return rows.select("conv_id", record.alias("record"))


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame([(-7, 0, "user", COLLIDING), (-7, 1, "assistant", COLLIDING)], "conv_id long, turn long, role string, text string")
    records = materialize(records_of(rows.unionByName(planted)))
    out = materialize(format_records(records, "conv_id", "record"))
    turns, loss = read_turns(F.col("formatted")), read_loss(F.col("formatted"), F.col("loss_spans"))
    read = out.select(F.col("key").alias("conv_id"), "layout", turns.alias("turns"), loss.alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


def _escape_sql(x: str, template: Template = TEMPLATE) -> str:
    """Code points of an escaped text: its own, one a backslash, one a control string."""
    added = [rf"(length({x}) - length(replace({x}, '\', '')))"] + [f"(length({x}) - length(replace({x}, '{c}', ''))) // {len(c)}" for c in template.controls()]
    return f"(length({x}) + {' + '.join(added)})"


ORACLE = f"""
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '{COLLIDING}'), (-7, 1, 'assistant', '{COLLIDING}')),
g AS (SELECT conv_id, count(*) AS n_turns, string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn, role, text) AS told,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
    sum({_escape_sql('role')} + {_escape_sql('text')} + {len(TEMPLATE.open + TEMPLATE.text + TEMPLATE.close)}) + {len(TEMPLATE.begin + TEMPLATE.end)} AS chars
  FROM r GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(told) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars FROM g
"""
