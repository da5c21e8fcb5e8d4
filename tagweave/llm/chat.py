"""Chat formatting: records of unlike layouts into one template. Built-in functions only.

A record's nested field paths are hashed to a fingerprint, and the fingerprint selects a
declarative mapping from those fields to turns. No record is tried against all mappings, and a
record of unknown layout is reported as such.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagweave.functions.lists import let

START, END, END_OF_TEXT = "<|im_start|>", "<|im_end|>", "<|endoftext|>"
# Strings that steer common chat templates. Inside a text a backslash follows their first
# character (one more if backslashes follow already), so none of them can be read as a mark.
_CONTROL = r"(<){0}(\|im_start\|>|\|im_end\|>|\|endoftext\|>|/?s>)|(\[){0}(/?INST\])"
_PLAIN = _CONTROL.format(r"(\\*)")
_ESCAPED = _CONTROL.format(r"\\(\\*)")


@dataclass(frozen=True)
class Mapping:
    """How records with one of the ``shapes`` become turns.

    Either ``turns`` names an array field with a role and a text field per element, or ``fields``
    lists (role, field) in the order of the turns; absent fields give no turn. ``roles`` renames.
    """

    name: str
    shapes: tuple[str, ...]
    turns: tuple[str, str, str] | None = None
    fields: tuple[tuple[str, str], ...] = ()
    roles: dict[str, str] = field(default_factory=dict)


def _list_shapes(name: str, *fields: str) -> tuple[str, ...]:
    element = ", ".join(f"{f}: _" for f in sorted(fields))
    return (f"OBJECT<{name}: ARRAY<OBJECT<{element}>>>", f"OBJECT<{name}: ARRAY<VOID>>")


def _flat_shape(*fields: str) -> str:
    return "OBJECT<" + ", ".join(f"{f}: _" for f in sorted(fields)) + ">"


MAPPINGS = (
    Mapping("messages", _list_shapes("messages", "role", "content"), ("messages", "role", "content")),
    Mapping(
        "from_value",
        _list_shapes("conversations", "from", "value"),
        ("conversations", "from", "value"),
        roles={"human": "user", "gpt": "assistant"},
    ),
    Mapping(
        "prompt",
        (_flat_shape("prompt", "response"), _flat_shape("system", "prompt", "response")),
        fields=(("system", "system"), ("user", "prompt"), ("assistant", "response")),
    ),
    Mapping(
        "instruction",
        (_flat_shape("instruction", "output"), _flat_shape("system", "instruction", "output")),
        fields=(("system", "system"), ("user", "instruction"), ("assistant", "output")),
    ),
)


def field_paths(record: Column) -> Column:
    """Nested field paths of a JSON record, with every scalar type written as ``_``.

    Lists without a value stay ``ARRAY<VOID>``, so an empty list of turns is no list of strings, and
    what is an object here and a string there stays ``VARIANT``, which no mapping takes.
    """
    schema = F.schema_of_variant(F.try_parse_json(record))
    scalar = r"\b(?:STRING|BIGINT|DOUBLE|BOOLEAN|(?<!ARRAY<)VOID|DECIMAL\(\d+,\s?\d+\))(?=[,>]|$)"
    return F.regexp_replace(schema, scalar, "_")


def fingerprint(paths: Column) -> Column:
    return F.xxhash64(paths)


def _turns(mapping: Mapping, value: Column) -> Column:
    text = lambda path: F.try_variant_get(value, path, "string")
    row = lambda role, content: F.struct(
        F.coalesce(role, F.lit("")).alias("role"), F.coalesce(content, F.lit("")).alias("text")
    )
    if mapping.turns:
        path, role, content = mapping.turns
        found = F.try_variant_get(
            value, f"$.{path}", f"array<struct<`{role}`:string,`{content}`:string>>"
        )
        renamed = lambda r: reduce(
            lambda out, pair: F.when(r == pair[0], pair[1]).otherwise(out),
            mapping.roles.items(),
            r,
        )
        return F.transform(found, lambda t: row(renamed(t[role]), t[content]))
    present = F.array_compact(
        F.array(
            *[
                F.when(F.try_variant_get(value, f"$.{name}", "variant").isNotNull(),
                       row(F.lit(role), text(f"$.{name}")))
                for role, name in mapping.fields
            ]
        )
    )
    return present


def canonical_turns(
    records: DataFrame, record_id: str, record: str, mappings: tuple[Mapping, ...] = MAPPINGS
) -> DataFrame:
    """(record_id, record_hash, fingerprint, layout, turns) of JSON records."""
    distinct = records.select(
        F.col(record_id).alias("record_id"),
        F.col(record).alias("record"),
        F.xxhash64(record).alias("record_hash"),
    ).dropDuplicates(["record_id", "record_hash"])
    parsed = distinct.select(
        "record_id",
        "record_hash",
        F.try_parse_json("record").alias("value"),
        fingerprint(field_paths(F.col("record"))).alias("fingerprint"),
    )
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast("array<struct<role:string,text:string>>")
    for mapping in mappings:
        known = F.col("fingerprint").isin([fingerprint(F.lit(s)) for s in mapping.shapes])
        layout = F.when(known, mapping.name).otherwise(layout)
        turns = F.when(known, _turns(mapping, F.col("value"))).otherwise(turns)
    return parsed.select(
        "record_id", "record_hash", "fingerprint", layout.alias("layout"), turns.alias("turns")
    )


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _PLAIN, r"$1$4\\$2$5$3$6")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$4$2$5$3$6")


def escape_role(role: Column) -> Column:
    """A role fits one line: backslash and line break are written as ``\\s`` and ``\\n``."""
    flat = F.replace(F.replace(role, F.lit("\\"), F.lit("\\s")), F.lit("\n"), F.lit("\\n"))
    return escape(flat)


def unescape_role(role: Column) -> Column:
    flat = unescape(role)
    return F.replace(F.replace(flat, F.lit("\\n"), F.lit("\n")), F.lit("\\s"), F.lit("\\"))


def format_chat(
    records: DataFrame,
    record_id: str = "record_id",
    record: str = "record",
    mappings: tuple[Mapping, ...] = MAPPINGS,
    loss_roles: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """One row per record: ``record_id``, ``fingerprint``, ``layout``, ``n_turns``, ``formatted``,
    ``loss_spans`` (code points of ``formatted`` under the loss mask, end exclusive).

    A turn is written as start mark, role, line break, text, end mark, line break. Control strings
    in texts and roles are escaped so that reading back gives the very same turns. The mask covers
    the texts of ``loss_roles``, without marks.

    Turns are formatted in rows of their own, positions are running sums per record, and a record
    is put together in the task that already holds its turns. A record is one output row, so all
    turns of one record meet; nothing else does. Null texts and roles count as empty, records with
    the same id and content count once, those with the same id and other content separately;
    records of unknown layout, also lists of unlike elements, or of broken JSON keep a row with null
    ``layout`` and ``formatted``;
    records without turns give an empty text; an empty table gives an empty one.
    """
    found = canonical_turns(records, record_id, record, mappings)
    key = ["record_id", "record_hash"]
    known = found.filter(F.col("layout").isNotNull())
    turns = known.select(
        *key, "fingerprint", "layout", F.posexplode_outer("turns").alias("pos", "turn")
    )
    head = F.concat(F.lit(START), escape_role(F.col("turn.role")), F.lit("\n"))
    pieces = turns.select(
        *key,
        "fingerprint",
        "layout",
        "pos",
        F.col("turn.role").isin(*loss_roles).alias("loss"),
        head.alias("head"),
        escape(F.col("turn.text")).alias("body"),
    ).withColumn("whole", F.concat("head", "body", F.lit(END + "\n")))
    so_far = Window.partitionBy(*key).orderBy("pos")
    placed = pieces.withColumn(
        "begin",
        F.sum(F.char_length("whole").cast("bigint")).over(so_far)
        - F.char_length("whole")
        + F.char_length("head"),
    )
    span = F.struct(
        F.col("begin").alias("start"), (F.col("begin") + F.char_length("body")).alias("end")
    )
    in_order = lambda c: F.transform(
        F.sort_array(F.collect_list(c)), lambda x: x["x"]
    )
    whole = placed.groupBy(*key).agg(
        F.first("fingerprint").alias("fingerprint"),
        F.first("layout").alias("layout"),
        F.count("whole").alias("n_turns"),
        F.array_join(
            in_order(F.when(F.col("whole").isNotNull(), F.struct("pos", F.col("whole").alias("x")))),
            "",
        ).alias("formatted"),
        in_order(F.when(F.col("loss"), F.struct("pos", span.alias("x")))).alias("loss_spans"),
    )
    unknown = found.filter(F.col("layout").isNull()).select("record_id", "fingerprint", "layout")
    return whole.drop("record_hash").unionByName(unknown, allowMissingColumns=True)


def read_turns(formatted: Column) -> Column:
    """Turns (role, text) of a formatted conversation."""
    parts = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda x, i: i > 0)

    def turn(part: Column) -> Column:
        role = F.substring_index(part, "\n", 1)
        skip = F.char_length(role) + 1
        text = F.substr(
            part, skip + 1, F.char_length(part) - skip - F.lit(len(END) + 1)
        )
        return F.struct(unescape_role(role).alias("role"), unescape(text).alias("text"))

    return F.transform(parts, turn)


def read_spans(formatted: Column, spans: Column) -> Column:
    """The stretches of ``formatted`` in ``spans``, one after the other, unescaped each."""

    def cut(chars: Column) -> Column:
        return F.transform(
            spans,
            lambda s: unescape(
                F.array_join(
                    F.slice(chars, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")), ""
                )
            ),
        )

    return F.array_join(let(F.split(formatted, ""), cut), "")


def records_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, record): one JSON record per conversation, in the layout that suits its turns.

    Rows are ordered by turn (ties by role and text). Two turns of user and assistant become a
    prompt record, with a system turn before them an instruction record; other conversations
    become message lists, those with odd ids and only known roles in the from/value style.
    """
    turn = F.struct(
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    packed = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("t"))
    roles = F.transform("t", lambda t: t["role"])
    said = lambda i: F.get("t", F.lit(i))["text"]
    as_from = lambda r: (
        F.when(r == "user", "human").when(r == "assistant", "gpt").otherwise(r)
    )
    plain = F.forall(roles, lambda r: r.isin("system", "user", "assistant"))
    prompt = F.struct(said(0).alias("prompt"), said(1).alias("response"))
    instruction = F.struct(
        said(0).alias("system"), said(1).alias("instruction"), said(2).alias("output")
    )
    from_value = F.struct(
        F.transform(
            "t", lambda t: F.struct(as_from(t["role"]).alias("from"), t["text"].alias("value"))
        ).alias("conversations")
    )
    messages = F.struct(
        F.transform(
            "t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content"))
        ).alias("messages")
    )
    same = lambda *names: roles == F.array(*[F.lit(n) for n in names])
    record = (
        F.when(same("user", "assistant"), F.to_json(prompt))
        .when(same("system", "user", "assistant"), F.to_json(instruction))
        .when(plain & (F.pmod("conv_id", F.lit(2)) == 1), F.to_json(from_value))
        .otherwise(F.to_json(messages))
    )
    return packed.select("conv_id", record.alias("record"))


def chat_digest(formatted: DataFrame) -> DataFrame:
    """Digests of what is read back from the formatted texts and their masks."""
    turns = read_turns(F.col("formatted"))
    spoken = F.array_join(
        F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    back = formatted.select(
        F.col("record_id").alias("conv_id"),
        F.size(turns).cast("bigint").alias("n_turns"),
        F.sha2(spoken, 256).alias("turns_sha256"),
        read_spans(F.col("formatted"), F.col("loss_spans")).alias("loss"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )
    return back.select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.char_length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
