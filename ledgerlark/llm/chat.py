"""Chat formatting: layouts recognised by fingerprint, turns rendered with a loss mask.

A record's layout is the set of nested field paths that it holds, out of the paths that the
known layouts name. The sorted paths are hashed, and the hash selects a declarative mapping
to canonical turns. So prompt and completion columns, instructions, message lists and rows
by turn go through one function, even mixed in one table, and fields that no layout knows
do no harm. Turns are rendered with control strings; the same strings inside texts are
escaped, so the rendering can always be read back. DataFrame and SQL operations only.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN = "struct<turn: bigint, role: string, text: string>"


@dataclass(frozen=True)
class Layout:
    """Paths that must and that may be there, and SQL for the array of turns of record ``r``."""

    name: str
    required: tuple[str, ...]
    optional: tuple[str, ...]
    turns: str

    def fingerprints(self) -> list[str]:
        return [
            fingerprint_of([*self.required, *extra])
            for n in range(len(self.optional) + 1)
            for extra in combinations(self.optional, n)
        ]


def fingerprint_of(paths: list[str]) -> str:
    return sha256("\n".join(sorted(paths)).encode()).hexdigest()


def _get(path: str, kind: str = "string") -> str:
    return f"try_variant_get(r, '$.{path}', '{kind}')"


def _list(items: str, role: str, text: str) -> str:
    return (
        f"transform({_get(items, 'array<variant>')}, (m, i) -> struct(cast(i AS bigint) AS turn, "
        f"try_variant_get(m, '$.{role}', 'string') AS role, try_variant_get(m, '$.{text}', 'string') AS text))"
    )


def _fixed(*turns: tuple[str, str]) -> str:
    """Turns from single fields; a role in front of which nothing was said is left out."""
    made = ", ".join(
        f"IF({text} IS NULL AND '{role}' = 'system', NULL, named_struct('turn', {i}L, 'role', '{role}', 'text', {text}))"
        for i, (role, text) in enumerate(turns)
    )
    return f"filter(array({made}), x -> x IS NOT NULL)"


LAYOUTS = (
    Layout("messages", ("messages[].role", "messages[].content"), (), _list("messages", "role", "content")),
    Layout("conversations", ("conversations[].from", "conversations[].value"), (), _list("conversations", "from", "value")),
    Layout(
        "turn_row",
        ("turn", "role", "text"),
        (),
        f"array(struct({_get('turn', 'bigint')} AS turn, {_get('role')} AS role, {_get('text')} AS text))",
    ),
    Layout(
        "instruction",
        ("instruction", "output"),
        ("input", "system"),
        _fixed(
            ("system", _get("system")),
            ("user", f"concat_ws('\\n\\n', {_get('instruction')}, nullif({_get('input')}, ''))"),
            ("assistant", _get("output")),
        ),
    ),
    Layout(
        "prompt",
        ("prompt", "completion"),
        ("system",),
        _fixed(("system", _get("system")), ("user", _get("prompt")), ("assistant", _get("completion"))),
    ),
    Layout(
        "response",
        ("prompt", "response"),
        ("system",),
        _fixed(("system", _get("system")), ("user", _get("prompt")), ("assistant", _get("response"))),
    ),
)
PATHS = sorted({p for layout in LAYOUTS for p in (*layout.required, *layout.optional)})
FIELDS = sorted({p.partition("[")[0] for p in PATHS})
# Other names of the three roles, in the layout that uses them.
ROLES = {"human": "user", "gpt": "assistant", "model": "assistant", "bot": "assistant"}


def held_paths(record: str) -> Column:
    """The known paths that a variant column holds; a field whose value is null is there.

    A path through a list is held if any of the list's elements holds it.
    """

    def found(path: str) -> str:
        items, inside, field = path.partition("[].")
        held = f"try_variant_get({record}, '$.{path}', 'variant') IS NOT NULL"
        if inside:
            each = f"try_variant_get({record}, '$.{items}', 'array<variant>')"
            held = f"exists({each}, m -> try_variant_get(m, '$.{field}', 'variant') IS NOT NULL)"
        return f"IF({held}, '{path}', NULL)"

    return F.expr(f"filter(array({', '.join(map(found, PATHS))}), p -> p IS NOT NULL)")


def fingerprint(paths: Column) -> Column:
    return F.sha2(F.array_join(F.array_sort(paths), "\n"), 256)


def layout_name(paths: Column, print_: Column) -> Column:
    """By fingerprint; a record with paths of several layouts goes by the first that it holds whole."""
    known: dict[str, str] = {}
    for layout in LAYOUTS:
        for x in layout.fingerprints():
            known.setdefault(x, layout.name)
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    first = F.lit(None).cast("string")
    for layout in reversed(LAYOUTS):
        whole = F.size(F.array_except(F.array(*map(F.lit, layout.required)), paths)) == 0
        first = F.when(whole, layout.name).otherwise(first)
    return F.coalesce(F.try_element_at(table, print_), first)


def canonical_turns(records: DataFrame, conversation: Column, body: Column | None = None) -> DataFrame:
    """One row per turn: ``conv_id``, ``turn``, ``role``, ``text``, ``layout``, ``fingerprint``.

    ``body`` is a JSON text or a variant column; without it the record is the table's own
    columns, as far as a layout names them, so other columns may have any names and types.
    NULL roles and texts are empty. A record of no known
    layout, or one without turns, gives a row with NULL turn and role, so it can be found.
    """
    if body is None:
        own = [c for c in records.columns if c in FIELDS]
        body = F.to_variant_object(F.struct(*[F.col(f"`{c}`") for c in own])) if own else F.lit(None).cast("variant")
    rows = records.select(conversation.cast("bigint").alias("conv_id"), body.alias("r"))
    if dict(rows.dtypes)["r"] == "string":
        rows = rows.withColumn("r", F.try_parse_json("r"))
    rows = rows.withColumn("paths", held_paths("r"))
    rows = rows.withColumn("fingerprint", fingerprint(F.col("paths")))
    rows = rows.withColumn("layout", layout_name(F.col("paths"), F.col("fingerprint")))
    by_layout = "CASE layout " + " ".join(f"WHEN '{x.name}' THEN CAST({x.turns} AS array<{TURN}>)" for x in LAYOUTS) + " END"
    rows = rows.select("conv_id", "layout", "fingerprint", F.explode_outer(F.expr(by_layout)).alias("t"))
    role = F.col("t.role")
    for other, name in ROLES.items():
        role = F.when((F.col("layout") == "conversations") & (F.col("t.role") == other), name).otherwise(role)
    there = F.col("t").isNotNull()
    return rows.select(
        "conv_id",
        F.col("t.turn").alias("turn"),
        F.when(there, F.coalesce(role, F.lit(""))).alias("role"),
        F.when(there, F.coalesce("t.text", F.lit(""))).alias("text"),
        "layout",
        "fingerprint",
    )


# The template. A turn is  <|im_start|>role, line break, text, <|im_end|>, line break.
START, END = "<|im_start|>", "<|im_end|>\n"
# Strings that some template gives a meaning. Inside a text the opening sign is followed by one
# backslash more than was there, which reading back takes away again.
_OPEN = r"(<\||</?|\[/?)"
_NAME = r"((?:im_start|im_end|system|user|assistant|endoftext|begin_of_text|end_of_text|eot_id)\|>|s>|(?:INST|SYS)\]|(?:SYS)>)"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _OPEN + r"(\\*)" + _NAME, r"$1$2\\$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _OPEN + r"\\(\\*)" + _NAME, "$1$2$3")


def _role(role: Column) -> Column:
    """Roles stand on one line: percent signs and line breaks are written as codes."""
    return escaped(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _role_back(role: Column) -> Column:
    return F.replace(F.replace(unescaped(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def render(turns: DataFrame, trained: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id``, ``segments`` (text, loss) and ``formatted``.

    Joined, the segments' texts are ``formatted``; ``loss`` marks what a model is trained to
    say: the texts of ``trained`` without their markers. Turns go by number, then role and
    text (NULL numbers first), repeated rows stay. Rows with a NULL conv_id are one
    conversation; rows without a role (see ``canonical_turns``) are left out. A conversation
    becomes one row, as a document is.
    """
    said = turns.where(F.col("role").isNotNull())
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    whole = said.groupBy("conv_id").agg(ordered.alias("turns"))

    def segments(t: Column) -> Column:
        def of(text: Column, loss: Column) -> Column:
            return F.struct(text.alias("text"), loss.alias("loss"))

        return F.array(
            of(F.concat(F.lit(START), _role(t["role"]), F.lit("\n")), F.lit(False)),
            of(escaped(t["text"]), t["role"] == trained),
            of(F.lit(END), F.lit(False)),
        )

    whole = whole.select("conv_id", F.flatten(F.transform("turns", segments)).alias("segments"))
    return whole.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a rendered conversation."""
    parts = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda x: x != "")

    def turn(part: Column) -> Column:
        line = F.instr(part, "\n")
        # A column expression may not take another as a length in every form, so these are calls.
        role = F.substr(part, F.lit(len(START) + 1), line - len(START) - 1)
        text = F.substr(part, line + 1, F.length(part))
        return F.struct(_role_back(role).alias("role"), unescaped(text).alias("text"))

    return F.transform(parts, turn)


def trained_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")
