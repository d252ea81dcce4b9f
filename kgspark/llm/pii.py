"""Personal data: base patterns, and identifiers that bootstrapped contexts find, with DataFrame functions only.

Base matches are the seeds. The words before an identifier are its lexical pattern. Patterns and instances form a graph:
a pattern is as good as the share of its instances that are believed, an instance as believable as its best pattern.
Spark scores the two in turns; identifiers behind high-confidence patterns become spans of their own kinds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kgspark.llm.common import cut, text_or_empty
from kgspark.llm.spans import SPAN, listed, located

#: The base kinds, in order, as Java patterns. A match may begin where the one before ended or where no
#: sign of its first class stands before it: elsewhere it couldn't match either, and long runs are not tried again and again.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++\.[A-Za-z0-9-][A-Za-z0-9.-]*?(?=\.(?![A-Za-z0-9-])|(?![A-Za-z0-9.-]))"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: A blank or hyphen that doesn't stand between digits; with those struck out a card is one run of one class.
LOOSE = r"(?<![0-9])[\x20-]|[\x20-](?![0-9])"
RUN = r"[0-9][0-9\x20-]*+"
MANY = r"[0-9](?:[\x20-]?[0-9]){13}"
KINDS = ("email", "ip", "card", "phone")
#: An identifier: a word with a digit, from its first letter or digit to its last; what it must have to be learned.
WORD = r"(?<![^\s\"'(<\[{=:,;|])[^\s\"'(<\[{=:,;|0-9]*+[0-9][^\s\"')>\]},;|]*+"
LEAST_LENGTH, LEAST_DIGITS = 5, 4
#: What else a slot behind a pattern may hold, by kind. Addresses: a word run with a sign for "at", or with the words at and dot.
_NAME, _HOST, _OPEN, _CLOSE = r"(?<![^\s\"'(<\[{=:,;|])[^\s\"'()<>\[\]{}=:,;|@]++", r"[\p{L}\p{N}_-]++", r"\x20?[(\[{<_]\x20?", r"\x20?[)\]}>_]\x20?"
ADDRESS = (
    rf"{_NAME}(?:(?:@|{_OPEN}(?i:at){_CLOSE}){_HOST}(?:(?:\.|{_OPEN}(?i:dot){_CLOSE}|\x20(?i:dot)\x20){_HOST})*+"
    rf"|\x20(?i:at)\x20{_HOST}(?:(?:\.|\x20(?i:dot)\x20){_HOST})++)"
)
#: Numbers: groups of digits joined by blanks, dots, hyphens, slashes or parentheses, the first one short or in parentheses.
_GROUP = r"[0-9]{1,7}+(?![\p{L}\p{N}_@])"
GROUPS = rf"(?<![\p{{L}}\p{{N}}_.+@/-])(?:\([0-9]{{1,5}}+\)[\x20./-]?|[0-9]{{1,6}}+\x20\(?){_GROUP}(?:\)?[\x20./-]{_GROUP}){{0,7}}+"
#: Network addresses: digits, or hex digits, in three parts at least.
PARTS = r"(?<![\p{L}\p{N}_.:+@-])(?:[0-9]++(?:\.[0-9]++){2,}+|(?:[0-9A-Fa-f]{1,4}+)?(?::{1,2}+[0-9A-Fa-f]{1,4}+){2,7}+)(?![\p{L}\p{N}_@])"
#: Code points of context that a pattern is read from, and its words.
CONTEXT, PATTERN = 80, r"((?:\S+\s+)?\S*[^\s\"'(<\[{=|])[\s\"'(<\[{=|]*$"


def luhn(digits: Column) -> Column:
    """Whether a text of digits passes the check sum that doubles every second digit from the right."""
    each = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: F.when(i % 2 == 1, F.when(d.cast("int") * 2 > 9, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)).otherwise(d.cast("int")),
    )
    return F.aggregate(each, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def base_spans(text: Column, context: int = CONTEXT) -> dict[str, Column]:
    """The base kinds' spans; matches that fail their checks are dropped and not tried again."""
    small = lambda part: (F.length(F.regexp_replace(part, "^0+", "")) < 3) | ((F.length(F.regexp_replace(part, "^0+", "")) == 3) & (F.right(part, F.lit(3)) <= "255"))
    digits = lambda s: F.regexp_replace(s["value"], "[^0-9]", "")
    card = located(F.regexp_replace(text, LOOSE, "x"), RUN, before=0, given=text.rlike(MANY))
    card = F.filter(card, lambda s: F.length(digits(s)).between(14, 19) & luhn(digits(s)))
    # The struck-out text has no context left in it.
    card = F.transform(card, lambda s: s.withField("before", F.substring(text, F.greatest(F.lit(1), s["start"] + 1 - context), F.least(s["start"], F.lit(context)))))
    return {
        "email": located(text, EMAIL, before=context, given=F.contains(text, F.lit("@"))),
        "ip": F.filter(located(text, IP, before=context, given=text.rlike(r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]")), lambda s: F.forall(F.split(s["value"], r"\."), small)),
        "card": card,
        "phone": F.filter(located(text, PHONE, before=context, given=F.contains(text, F.lit("+"))), lambda s: F.length(digits(s)).between(10, 15)),
    }


def pattern_of(before: Column) -> Column:
    """The one or two words before an identifier, in lower case; empty where nothing stands before it."""
    return F.lower(F.regexp_replace(F.regexp_extract(before, PATTERN, 1), r"\s+", " "))


def mentions(rows: DataFrame) -> DataFrame:
    """Pattern, instance and kind (null: not known) of each identifier: base spans and other words with digits."""

    def mention(kind: Column):
        return lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), pattern_of(s["before"]).alias("pattern"), kind.alias("kind"))

    seeds = [F.transform(F.col(k), mention(F.lit(k))) for k in KINDS]
    other = F.transform(F.col("other"), lambda s: mention(F.lit(None).cast("string"))(s).withField("form", s["group"]))
    seeds = [F.transform(x, lambda s: s.withField("form", F.lit(None).cast("string"))) for x in seeds]
    return rows.select("row", F.explode(F.concat(*seeds, other)).alias("m")).select("row", "m.*").filter("pattern <> ''")


def fits(kind: str, form: Column) -> Column:
    """Whether an identifier of this form may be of a kind; a word of many digits may be of any."""
    return F.array_contains(F.split(form, " "), kind)


def confident(found: DataFrame, rounds: int | None = None, support: int = 3, confidence: float = 0.6) -> DataFrame:
    """Score the pattern-instance graph; return patterns, each with the kind that its instances are believed to be.

    An edge counts once, however often copies of a text repeat it. Seeds are believed fully, others as much as their best
    pattern so far. A pattern needs ``support`` different instances believed by ``confidence`` (at first only seeds are) and a
    mean belief of ``confidence``, one instance of no belief added to its mean. Rounds go on until no pattern is added and no
    belief grows by more than a hundredth, or for ``rounds``. Belief from a pattern that isn't confident stays what its seeds
    gave it, so that it can't raise itself.
    """
    is_kind = {k: F.max((F.coalesce(F.col("kind"), F.lit("")) == k).cast("double")).alias(k) for k in KINDS}
    may = {k: F.max(F.coalesce(fits(k, F.col("form")), F.lit(False))).alias(f"may_{k}") for k in KINDS}
    edges = cut(found.groupBy("pattern", "value").agg(*is_kind.values(), *may.values()), "edges")
    believed, scores, turn = edges, None, 0
    while True:
        turn += 1
        counted = believed.groupBy("pattern").agg(
            *[F.sum((F.col(k) >= confidence).cast("long")).alias(f"n_{k}") for k in KINDS], *[(F.sum(k) / (F.count("*") + 1)).alias(k) for k in KINDS]
        ).filter(F.greatest(*[f"n_{k}" for k in KINDS]) >= support)
        counted = counted.select("pattern", *[F.col(k).alias(f"score_{k}") for k in KINDS], *[((F.col(f"n_{k}") >= support) & (F.col(k) >= confidence)).alias(f"sure_{k}") for k in KINDS])
        before = counted.select("pattern", *[F.lit(0.0).alias(f"old_{k}") for k in KINDS]) if scores is None else scores.select("pattern", *[F.col(k).alias(f"old_{k}") for k in KINDS])
        # What a pattern passes on: its score if it is sure, else what its seeds gave in the first round.
        passed = [(F.when(F.col(f"sure_{k}"), F.col(f"score_{k}")).otherwise(F.col(f"score_{k}") if turn == 1 else F.coalesce(F.col(f"old_{k}"), F.lit(0.0)))).alias(k) for k in KINDS]
        now = counted.join(before, "pattern", "left")
        grown = F.greatest(*[F.when(F.col(f"sure_{k}"), F.col(f"score_{k}") - F.coalesce(F.col(f"old_{k}"), F.lit(0.0))).otherwise(0.0) for k in KINDS])
        scores = cut(now.select("pattern", *passed, *[f"sure_{k}" for k in KINDS], *[f"score_{k}" for k in KINDS], grown.alias("grown")), "patterns")
        if turn == rounds or (turn > 1 and scores.filter("grown > 0.01").isEmpty()):
            break
        # Belief spreads along edges; an instance takes the best of its patterns, for kinds that its form may have.
        spread = edges.select("pattern", "value").join(scores.select("pattern", *KINDS), "pattern").groupBy("value").agg(*[F.max(k).alias(f"from_{k}") for k in KINDS])
        believed = edges.join(spread, "value", "left").select(
            "pattern", "value", *[F.greatest(F.col(k), F.when(F.col(f"may_{k}"), F.col(f"from_{k}")).otherwise(0.0)).alias(k) for k in KINDS]
        )
    best = F.greatest(*[F.struct(F.when(F.col(f"sure_{k}"), F.col(f"score_{k}")).otherwise(0.0).alias("score"), F.lit(k).alias("kind")) for k in KINDS])
    return scores.select("pattern", best.alias("best")).filter(F.col("best.score") >= confidence).select("pattern", F.col("best.kind").alias("kind"))


def with_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int | None = None, support: int = 3, confidence: float = 0.6) -> DataFrame:
    """Personal data in whole texts: a row per input row with the id, a column of spans for each base kind, and
    ``found``, spans (``kind``, ``start``, ``end``) of identifiers that stand behind high-confidence patterns.

    Found kinds are named after the seeds' kind, ``like_email`` and so on; they never overlap base spans. Null texts are
    empty; null ids and repeated rows are kept as rows of their own; other columns are ignored. Every text is read once.
    """
    text = text_or_empty(text_col)
    base = base_spans(F.col("text"))
    text_ = F.col("text")
    digits = lambda s: F.length(F.regexp_replace(s["value"], "[^0-9]", ""))
    forms = {
        "address": (located(text_, ADDRESS, before=CONTEXT, given=text_.rlike(r"@|(?i:[(\[{<_\x20]at[)\]}>_\x20])")), "email", lambda s: F.lit(True)),
        "parts": (located(text_, PARTS, before=CONTEXT, given=text_.rlike(r"[0-9]\.[0-9]+\.[0-9]|:[0-9A-Fa-f]{0,4}:")), "ip card phone", lambda s: s["value"].rlike("[0-9]")),
        "groups": (located(text_, GROUPS, before=CONTEXT, given=text_.rlike(r"[0-9][)\x20]")), "card phone", lambda s: digits(s) >= LEAST_DIGITS),
        "word": (located(text_, WORD, before=CONTEXT, given=text_.rlike("[0-9]")), " ".join(KINDS), lambda s: (F.length(s["value"]) >= LEAST_LENGTH) & (digits(s) >= LEAST_DIGITS)),
    }
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), text.alias("text")).select("row", "id", *[base[k].alias(k) for k in KINDS], *[x.alias(name) for name, (x, _, _) in forms.items()])
    rows = rows.withColumn("taken", F.flatten(F.array(*[F.transform(F.col(k), lambda s: F.struct(s["start"], s["end"])) for k in KINDS])))
    rows = rows.withColumn("other", F.array().cast(SPAN))
    for name, (_, kinds, fit) in forms.items():  # a form leaves out what overlaps one before it
        free = lambda s: fit(s) & ~F.exists(F.col("taken"), lambda t: (t["start"] < s["end"]) & (s["start"] < t["end"]))  # noqa: B023, E731
        rows = rows.withColumn("more", F.transform(F.filter(F.col(name), free), lambda s: s.withField("group", F.lit(kinds))))  # noqa: B023
        rows = rows.withColumn("other", F.concat("other", "more")).withColumn("taken", F.concat("taken", F.transform("more", lambda s: F.struct(s["start"], s["end"]))))
    rows = cut(rows.select("row", "id", *KINDS, "other"), "identifiers")
    known = mentions(rows)
    patterns = confident(known, rounds, support, confidence)
    found = (
        known.filter("kind is null").drop("kind").join(patterns, "pattern").filter(F.array_contains(F.split("form", " "), F.col("kind"))).groupBy("row")
        .agg(F.array_sort(F.collect_list(F.struct("start", "end", F.concat(F.lit("like_"), "kind").alias("kind")))).alias("found"))
    )  # at most the identifiers of one text
    none = F.array().cast("array<struct<start:int,end:int,kind:string>>")
    return rows.join(found, "row", "left").select(F.col("id").alias(id_col), *KINDS, F.coalesce("found", none).alias("found"))


def digest_columns(spans: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, the digest of their spans, and all spans as text."""
    base = {k: F.col(k) for k in KINDS}

    def like(kind: str) -> Column:
        return F.transform(F.filter("found", lambda s: s["kind"] == kind), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))

    every = base | {f"like_{k}": like(f"like_{k}") for k in KINDS}
    return spans.select(
        id_col, *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS], F.sha2(F.encode(listed(base), "UTF-8"), 256).alias("base_sha256"), listed(every).alias("spans"),
    )
