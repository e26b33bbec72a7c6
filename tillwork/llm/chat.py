"""Chat formatting: schema fingerprints choose how a payload becomes turns. DataFrame functions only.

A payload is JSON of any of several layouts. The nested field paths of each payload, without
values or types, are hashed; the hash selects a declarative mapping (where the turns are, which
fields hold role and text, what roles are called) that converts it to canonical turns. Payloads of
an unknown layout come back as such, they are not guessed at.

Turns are written as ``<|im_start|>role``, a line break, the text, ``<|im_end|>`` and a line
break. A ``<`` and any backslashes before a ``|`` in a text get one more backslash, so no control
string can come from a text, and reading takes that one away again. The loss
mask marks the texts of assistant turns.

A null text counts as empty, a null role as the empty role. Rows of a conversation are
ordered by turn, then role, then text; repeated rows are turns of their own. A payload
that isn't JSON has no layout. Texts may have any length: the layout is found with empty texts, since
parsing to a variant is limited to strings of 20 million characters and 128 MiB. Empty tables give no conversations.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

START, END = "<|im_start|>", "<|im_end|>"
#: Turns of a stored payload; longer conversations are stored as several.
PAYLOAD_TURNS = 64
#: Bytes of the texts and roles of a stored payload; above that each turn is a payload of its own.
PAYLOAD_BYTES = 1 << 25
#: Texts are read at any length; a payload of a known layout that cannot be read is an error.
READING = {"maxStringLen": str((1 << 31) - 1), "mode": "FAILFAST"}
LEARNED_ROLE = "assistant"


@dataclass(frozen=True)
class Mapping:
    """Either ``turns`` names a list with ``role`` and ``text`` in each element, or ``fields`` lists (path, role)."""

    name: str
    turns: str | None = None
    role: str = ""
    text: str = ""
    fields: tuple[tuple[str, str], ...] = ()
    optional: tuple[str, ...] = ()
    roles: tuple[tuple[str, str], ...] = ()

    def path_sets(self) -> list[list[str]]:
        """The field paths of payloads this mapping reads, for each choice of optional fields."""
        if self.turns:
            base = [f"{self.turns}[].{self.role}", f"{self.turns}[].{self.text}"]
        else:
            base = [path for path, _ in self.fields if path not in self.optional]
        return [sorted([*base, *more]) for k in range(len(self.optional) + 1)
                for more in combinations(self.optional, k)]


MAPPINGS = (
    Mapping("messages", turns="messages", role="role", text="content"),
    Mapping("exchange", turns="conversations", role="from", text="value",
            roles=(("human", "user"), ("gpt", "assistant"))),
    Mapping("dialog", turns="dialog.turns", role="speaker.name", text="utterance.text"),
    Mapping("prompt", fields=(("system", "system"), ("prompt", "user"), ("response", "assistant")),
            optional=("system",)),
    Mapping("instruction", fields=(("instruction", "system"), ("input", "user"), ("output", "assistant"))),
)


def _shape(paths: list[str]) -> str:
    """Field paths as the nested text that Spark's variant schema becomes without types."""
    tree: dict = {}
    for path in paths:
        at = tree
        for step in path.replace("[]", ".[]").split("."):
            at = at.setdefault(step, {})

    def show(node: dict) -> str:
        if "[]" in node:
            return f"ARRAY<{show(node['[]'])}>"
        if not node:
            return "_"
        return f"OBJECT<{', '.join(f'{k}: {show(node[k])}' for k in sorted(node))}>"

    return show(tree)


#: A field name with its colon, or the quotes around another string of valid JSON.
_CONTENT = r'(?:[^"\\\x00-\x1f]++|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*+'
_STRINGS = rf'("{_CONTENT}"\s*+:)|("){_CONTENT}(")'


def shape(payload: Column) -> Column:
    """The nested field paths of a JSON payload; null if it isn't JSON."""
    schema = F.schema_of_variant(F.try_parse_json(F.regexp_replace(payload, _STRINGS, "$1$2$3")))
    return F.regexp_replace(schema, r"(?<=: |<|^)(?!OBJECT<|ARRAY<)[A-Z]+(\(\d+, ?\d+\))?(?=,|>|$)", "_")


def fingerprint(payload: Column) -> Column:
    return F.xxhash64(shape(payload))


def _steps(value: Column, path: str) -> Column:
    for step in path.split("."):
        value = value.getField(step)
    return value


def _ddl(paths: list[str]) -> str:
    tree: dict = {}
    for path in paths:
        at = tree
        for step in path.replace("[]", ".[]").split("."):
            at = at.setdefault(step, {})

    def show(node: dict) -> str:
        if "[]" in node:
            return f"array<{show(node['[]'])}>"
        return f"struct<{','.join(f'`{k}`:{show(v)}' for k, v in node.items())}>" if node else "string"

    return show(tree)


TURNS = "array<struct<role:string,text:string>>"


def _converted(payload: Column, mapping: Mapping) -> Column:
    """Canonical turns of a payload in this mapping's layout."""
    value = F.from_json(payload, _ddl(mapping.path_sets()[-1]), READING)
    if mapping.turns:
        def turn(x):
            role = _steps(x, mapping.role)
            named = role
            for theirs, ours in mapping.roles:
                named = F.when(role == theirs, F.lit(ours)).otherwise(named)
            return F.struct(F.coalesce(named, F.lit("")).alias("role"),
                            F.coalesce(_steps(x, mapping.text), F.lit("")).alias("text"))
        return F.transform(_steps(value, mapping.turns), turn).cast(TURNS)
    parts = []
    for path, role in mapping.fields:
        text = _steps(value, path)
        part = F.struct(F.lit(role).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
        parts.append(F.when(text.isNotNull(), part) if path in mapping.optional else part)
    return F.filter(F.array(*parts), lambda x: x.isNotNull()).cast(TURNS)


def canonical(payloads: DataFrame, mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """Add ``layout`` (null if unknown) and ``turns`` to rows with a ``payload``."""
    known = [(m, paths) for m in mappings for paths in m.path_sets()]
    table = F.create_map(*[x for m, paths in known
                           for x in (F.xxhash64(F.lit(_shape(paths))), F.lit(m.name))])
    named = payloads.withColumn("fingerprint", fingerprint(F.col("payload")))
    named = named.withColumn("layout", F.try_element_at(table, F.col("fingerprint")))
    turns = F.lit(None).cast(TURNS)
    for m in mappings:
        turns = F.when(F.col("layout") == m.name, _converted(F.col("payload"), m)).otherwise(turns)
    return named.withColumn("turns", turns)


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def segments(turns: Column) -> Column:
    """The formatted text in pieces, each with its place in the loss mask."""
    def pieces(t):
        # a role is one line without control characters
        head = F.concat(F.lit(START), F.url_encode(t["role"]), F.lit("\n"))
        return F.array(F.struct(head.alias("text"), F.lit(False).alias("loss")),
                       F.struct(escape(t["text"]).alias("text"), (t["role"] == LEARNED_ROLE).alias("loss")),
                       F.struct(F.lit(f"{END}\n").alias("text"), F.lit(False).alias("loss")))
    return F.flatten(F.transform(turns, pieces))


def formatted(pieces: Column) -> Column:
    return F.array_join(F.transform(pieces, lambda p: p["text"]), "")


def read_turns(text: Column) -> Column:
    """Canonical turns of a formatted text."""
    def turn(part):
        role = F.substring_index(part, "\n", 1)
        head = F.char_length(role) + 2
        body = F.substring(part, head, F.char_length(part) - head + 1 - (len(END) + 1))
        return F.struct(F.url_decode(role).alias("role"), unescape(body).alias("text"))
    return F.transform(F.slice(F.split(text, r"<\|im_start\|>", -1), 2, 1 << 30), turn)


def assemble(payloads: DataFrame) -> DataFrame:
    """``conv_id`` with its turns over all payloads in order; unknown layouts make ``unmapped`` true."""
    parts = canonical(payloads).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("part", "turns"))).alias("parts"),
        F.max(F.col("layout").isNull()).alias("unmapped"))
    turns = F.flatten(F.transform("parts", lambda p: F.coalesce(p["turns"], F.array().cast(TURNS))))
    return parts.select("conv_id", "unmapped", segments(turns).alias("segments"))


def as_payloads(conversations: DataFrame, size: int = PAYLOAD_TURNS, most_bytes: int = PAYLOAD_BYTES) -> DataFrame:
    """Rows by turn as JSON payloads of every layout that can hold them, at most ``size`` turns and,
    unless it is a single turn, ``most_bytes`` each."""
    rows = conversations.select(
        "conv_id", F.floor(F.coalesce(F.col("turn"), F.lit(-1)) / size).alias("part"),
        F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"),
                 F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    all_bytes = F.sum(F.octet_length("t.role").cast("long") + F.octet_length("t.text"))
    whole = rows.groupBy("conv_id", "part").agg(
        F.array_sort(F.collect_list("t")).alias("t"), F.when(all_bytes > most_bytes, 1).otherwise(size).alias("per"))
    cuts = F.transform(F.sequence(F.lit(0), F.floor((F.size("t") - 1) / F.col("per")).cast("int")),
                       lambda i: F.struct(i.alias("no"), F.slice("t", i * F.col("per") + 1, F.col("per")).alias("t")))
    parts = whole.select("conv_id", "part", F.explode(cuts).alias("cut")) \
        .select("conv_id", F.struct("part", "cut.no").alias("part"), "cut.t")
    role = lambda i: F.get("t", F.lit(i))["role"]
    text = lambda i: F.get("t", F.lit(i))["text"]
    n, pick = F.size("t"), F.abs(F.xxhash64("conv_id", "part")) % 3
    pair = (n == 2) & (role(0) == "user") & (role(1) == "assistant")
    triple = (n == 3) & (role(0) == "system") & (role(1) == "user") & (role(2) == "assistant")
    plain = ~F.exists("t", lambda x: x["role"].isin("human", "gpt"))
    listed = lambda f: F.transform("t", f)
    called = lambda x: F.when(x["role"] == "user", "human").when(
        x["role"] == "assistant", "gpt").otherwise(x["role"])
    return parts.select("conv_id", "part", (
        F.when(pair & (pick == 0), F.to_json(F.struct(text(0).alias("prompt"), text(1).alias("response"))))
        .when(triple & (pick == 0), F.to_json(F.struct(
            text(0).alias("instruction"), text(1).alias("input"), text(2).alias("output"))))
        .when(triple & (pick == 1), F.to_json(F.struct(
            text(0).alias("system"), text(1).alias("prompt"), text(2).alias("response"))))
        .when(plain & (pick == 1), F.to_json(F.struct(listed(lambda x: F.struct(
            called(x).alias("from"), x["text"].alias("value"))).alias("conversations"))))
        .when(pick == 2, F.to_json(F.struct(F.struct(listed(lambda x: F.struct(
            F.struct(x["role"].alias("name")).alias("speaker"),
            F.struct(x["text"].alias("text")).alias("utterance"))).alias("turns")).alias("dialog"))))
        .otherwise(F.to_json(F.struct(listed(lambda x: F.struct(
            x["role"].alias("role"), x["text"].alias("content"))).alias("messages"))))
    ).alias("payload"))


def digests(chats: DataFrame) -> DataFrame:
    """What a reader finds in the formatted conversations."""
    read = chats.withColumn("formatted", formatted(F.col("segments"))) \
        .withColumn("turns", read_turns(F.col("formatted"))) \
        .withColumn("learned", F.array_join(F.transform(
            F.filter("segments", lambda p: p["loss"]), lambda p: unescape(p["text"])), ""))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"), "unmapped")
