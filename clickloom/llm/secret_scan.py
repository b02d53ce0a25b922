"""Secret scan: credentials by pattern, weak candidates only where complementary parts meet.

Every part of a credential is a span of a text: a secret (assigned values, hexadecimal runs),
an access identifier (key ids, login names) or an endpoint (URLs). The three base kinds are
reported wherever they stand. The weak kinds mean nothing alone: a short password, a short
hexadecimal run, a value whose name ends in ``_key`` or begins with ``secret_``, or a long token
of small and capital letters and digits is reported when an identifier or endpoint stands in
its scope, a login name or an endpoint when a secret does. The scope of a part reaches
``reach`` code points to both sides; of the last two kinds the partner has to stand apart, as a
token inside a URL is a part of that URL. Linking is an interval join: parts are cut into bins of positions and joined within
(text, bin). Only DataFrame expressions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import fresh, full_text, put, written

REACH = 200

_QUOTE = """["']?"""
_IS = rf"{_QUOTE}\x20*[:=]\x20*{_QUOTE}"


def any_case(word: str) -> str:
    """Pattern of a word whose ASCII letters may have either case."""
    return "".join(f"[{c}{c.upper()}]" if "a" <= c <= "z" else c for c in word)


_WORDS = "|".join(any_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
_NAMES = "|".join(any_case(w) for w in ("username", "user", "login", "client_id", "account_id"))
_SCHEMES = "https?|ftps?|sftp|ssh|jdbc|postgres(?:ql)?|mysql|redis|mongodb|amqps?|s3"

_KEY, _SECRET = any_case("_key"), any_case("secret_")
_TOKEN = r"[A-Za-z0-9+/_=-]"

# pattern and the group whose length counts, for each way a part is found
PATTERNS = {
    "assign": (rf"({_WORDS}){_IS}([A-Za-z0-9+/_.=-]+)", 2),
    "access": (r"AKIA[A-Z0-9]{12,}", 0),
    "hex": (r"[0-9a-f]{16,}", 0),
    "login": (rf"({_NAMES}){_IS}([A-Za-z0-9@._-]{{3,}})", 2),
    "endpoint": (rf"(?:{_SCHEMES})://[^\x00-\x20\"'<>]{{4,}}", 0),
    "named": (
        rf"(?:[A-Za-z0-9_]{{0,40}}{_KEY}|{_SECRET}[A-Za-z0-9_]{{1,40}}){_IS}({_TOKEN}{{8,}})",
        1,
    ),
    # looked for in the text with a space before it; the part is the group alone
    "mixed": (rf"[\x20\x09-\x0D\"'=:,(\[]([A-Za-z0-9+]{_TOKEN}{{19,}})", 1),
}
PADDED = "mixed"
CLASSES = ("[a-z]", "[A-Z]", "[0-9]")
# kind: (pattern it comes from, least and greatest length that counts, class, weak), in the
# order in which kinds that start together are listed
KINDS = {
    "assign": ("assign", 8, None, "secret", False),
    "access": ("access", 16, None, "partner", False),
    "hex": ("hex", 32, None, "secret", False),
    "short": ("assign", 4, 7, "secret", True),
    "run": ("hex", 16, 31, "secret", True),
    "login": ("login", 3, None, "partner", True),
    "endpoint": ("endpoint", 4, None, "partner", True),
    "named": ("named", 8, None, "secret", True),
    "mixed": ("mixed", 20, None, "secret", True),
}
# kinds that link only with a partner they do not overlap
APART = ("named", "mixed")
BASE = [kind for kind, (*_, weak) in KINDS.items() if not weak]
# without one of these a text has no base kind and no secret, so nothing to report
FIRST_LOOK = (
    rf"(?:{_WORDS}){_IS}[A-Za-z0-9+/_.=-]{{4}}|AKIA[A-Z0-9]{{12}}|[0-9a-f]{{16}}|{_TOKEN}{{20}}"
    rf"|(?:{_KEY}|{_SECRET}[A-Za-z0-9_]{{1,40}}){_IS}{_TOKEN}{{8}}"
)

SPANS = "array<struct<start:bigint,kind:string,end:bigint>>"


def _found(text: Column, name: str) -> Column:
    """Matches of a pattern in order: length of the text before each, its length, its group's."""
    pattern, group = PATTERNS[name]
    padded = name == PADDED
    text = F.concat(F.lit(" "), text) if padded else text
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    counted = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits
    zipped = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), hits.alias("hit"), counted.alias("counted")
    )
    return F.transform(
        zipped,
        lambda x: F.struct(
            F.lit(name).alias("name"),
            F.char_length(x["gap"]).cast("long").alias("gap"),
            F.char_length(x["hit"]).cast("long").alias("size"),
            F.char_length(x["counted"]).cast("long").alias("counted"),
            all_classes(x["counted"]).alias("all") if padded else F.lit(True).alias("all"),
        ),
    )


def all_classes(token: Column) -> Column:
    found = F.lit(True)
    for some in CLASSES:
        found = found & token.rlike(some)
    return found


def _parts(texts: DataFrame) -> DataFrame:
    """(place, start, end, kind, rank, side, weak) of all parts of (place, text)."""
    found = texts.select(
        "place",
        F.posexplode(F.concat(*[_found(F.col("text"), name) for name in PATTERNS])),
    ).select("place", "pos", "col.*")
    so_far = Window.partitionBy("place", "name").orderBy("pos")
    end = F.sum(F.col("gap") + F.coalesce("size", F.lit(0))).over(so_far)
    padded = F.col("name") == PADDED
    spans = (
        found.withColumn("end", end)
        .where(F.col("size").isNotNull() & F.col("all"))
        .withColumns(
            {
                "end": F.col("end") - F.when(padded, 1).otherwise(0),
                "size": F.when(padded, F.col("counted")).otherwise(F.col("size")),
            }
        )
    )
    kinds = F.filter(
        F.array(
            *[
                F.when(
                    (F.col("name") == name) & F.col("counted").between(least, most or 2**31 - 1),
                    F.struct(
                        F.lit(kind).alias("kind"),
                        F.lit(rank).alias("rank"),
                        F.lit(side).alias("side"),
                        F.lit(weak).alias("weak"),
                    ),
                )
                for rank, (kind, (name, least, most, side, weak)) in enumerate(KINDS.items())
            ]
        ),
        lambda x: x.isNotNull(),
    )
    return spans.select(
        "place", (F.col("end") - F.col("size")).alias("start"), "end", F.explode(kinds).alias("k")
    ).select("place", "start", "end", "k.*")


def _linked(parts: DataFrame, reach: int) -> DataFrame:
    """The weak parts that have a complementary part in scope."""
    width = 2 * reach + 1

    def bins(low: Column, high: Column) -> Column:
        return F.explode(
            F.sequence(F.floor(low / width).cast("long"), F.floor(high / width).cast("long"))
        )

    start, end = F.col("start"), F.col("end")
    secrets = parts.where(F.col("side") == "secret").withColumn(
        "bin", bins(start - reach, end - 1 + reach)
    )
    partners = parts.where(F.col("side") == "partner").withColumn("bin", bins(start, end - 1))
    s, p = secrets.alias("s"), partners.alias("p")
    near = (
        (F.col("s.place") == F.col("p.place"))
        & (F.col("s.bin") == F.col("p.bin"))
        & (F.col("p.start") < F.col("s.end") + reach)
        & (F.col("p.end") > F.col("s.start") - reach)
        & (
            ~F.col("s.kind").isin(*APART)
            | (F.col("p.end") <= F.col("s.start"))
            | (F.col("p.start") >= F.col("s.end"))
        )
    )
    weak_secrets = s.where("weak").join(p, near, "left_semi")
    weak_partners = p.where("weak").join(s, near, "left_semi")
    return weak_secrets.unionByName(weak_partners).drop("bin").distinct()


def scan_secrets(docs: DataFrame, text: str = "text", reach: int = REACH) -> DataFrame:
    """Every row of ``docs`` with ``secret_spans``, ordered by start, then as in ``KINDS``.

    A span has ``start``, ``kind`` and ``end``; positions are code points, the end is
    exclusive. A text that is null, empty or without a part has an empty array, never
    null. Rows that repeat each other each get their spans. An empty table gives an empty
    table. A column of ``docs`` called ``secret_spans`` is replaced.

    Rows whose text cannot hold a secret or a key id pass straight through; only the
    others are written, cut into spans and joined.
    """
    value, (place, found) = full_text(text), fresh(docs, "place", "found")
    look = value.rlike(FIRST_LOOK)
    clean = put(docs.where(~look), {"secret_spans": F.array().cast(SPANS)})

    flagged = written(
        docs.where(look).withColumn(place, F.monotonically_increasing_id()), "secret-rows"
    )
    parts = written(
        _parts(flagged.select(F.col(place).alias("place"), full_text(text).alias("text"))),
        "secret-parts",
    )
    spans = (
        parts.where(~F.col("weak"))
        .unionByName(_linked(parts, reach))
        .groupBy(F.col("place").alias(place))
        .agg(F.sort_array(F.collect_list(F.struct("start", "rank", "kind", "end"))).alias(found))
    )
    joined = flagged.join(spans, place, "left")
    ordered = F.transform(joined[found], lambda x: F.struct(x["start"], x["kind"], x["end"]))
    hits = put(
        joined, {"secret_spans": F.coalesce(ordered.cast(SPANS), F.array().cast(SPANS))}
    ).drop(place, found)
    return clean.unionByName(hits.select(clean.columns))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ","
    )


def base_spans(spans: Column) -> Column:
    return F.filter(spans, lambda x: x["kind"].isin(BASE))
