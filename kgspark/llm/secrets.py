"""Secret scans through an inverted index of trigrams, with DataFrame functions only.

From each rule's pattern a Boolean query over trigrams is derived: what every match must contain. The index holds postings
of the trigrams that some query names. Postings are intersected by document; only documents that satisfy a rule's query are
searched with its pattern. Rules without mandatory trigrams are searched for everywhere.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kgspark.llm.common import cut, keyed_text, text_or_empty
from kgspark.llm.spans import listed, located


@dataclass(frozen=True)
class Rule:
    """A pattern for Java's matcher; of its group ``group`` (0: the match) at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: The three base rules, then rules that add spans of other kinds.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
ADDED = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("code_host", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("map_key", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("bearer", r"Authorization: (?:Bearer|Basic) [A-Za-z0-9+/_.=-]{16,}"),
    Rule("login", r"(?:https|http|ftp|postgres|mysql|redis|amqp)://[A-Za-z0-9._-]+:[^\s/@:\"']{3,}@[A-Za-z0-9.-]+"),
)

#: A query: None says nothing, a text is a trigram, ("and" | "or", parts) joins queries.
Query = None | str | tuple


def _all(parts: list[Query]) -> Query:
    flat = [q for p in parts if p is not None for q in (p[1] if isinstance(p, tuple) and p[0] == "and" else (p,))]
    flat = list(dict.fromkeys(flat))
    return None if not flat else flat[0] if len(flat) == 1 else ("and", tuple(flat))


def _one(parts: list[Query]) -> Query:
    """Any of the parts; a part that asks for all that another asks for, and more, says nothing new."""
    if None in parts or not parts:
        return None
    asks = {p: frozenset(p[1]) if isinstance(p, tuple) and p[0] == "and" else frozenset([p]) for p in parts}
    kept = [p for p in asks if not any(other < asks[p] for other in asks.values())]
    return kept[0] if len(kept) == 1 else ("or", tuple(kept))


def trigrams(text: str) -> Query:
    return _all([text[i : i + 3] for i in range(len(text) - 2)])


def trigram_query(pattern: str, most: int = 64) -> Query:
    """What the lower-cased text of every match must contain.

    Walks the parsed pattern and keeps the set of all texts that the part so far can be, as long as it is finite and has
    at most ``most`` members; where it is not, what is known so far becomes a condition and a new set begins.
    """
    import re._parser as parser

    def walk(nodes) -> tuple[set[str] | None, list[Query]]:
        """Texts that the whole run can be (None: unknown), and conditions besides."""
        exact, ends, conditions = {""}, True, []

        def flush():
            nonlocal exact, ends
            conditions.append(_one([trigrams(x) for x in sorted(exact)]))
            exact, ends = {""}, False

        for op, arg in nodes:
            name = str(op)
            options: set[str] | None = None
            more: list[Query] = []
            if name == "LITERAL":
                options = {chr(arg).lower()}
            elif name == "IN" and all(str(k) == "LITERAL" for k, _ in arg):
                options = {chr(v).lower() for _, v in arg}
            elif name == "SUBPATTERN":
                options, more = walk(arg[-1])
            elif name in ("ATOMIC_GROUP",):
                options, more = walk(arg)
            elif name == "BRANCH":
                each = [walk(x) for x in arg[1]]
                if all(x is not None and not c for x, c in each):
                    options = set().union(*(x for x, _ in each))
                else:
                    more = [_one([_all([*c, _one([trigrams(t) for t in sorted(x)]) if x is not None else None]) for x, c in each])]
            elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
                least, largest, inner = arg
                within, c = walk(inner)
                if largest == 1 and within is not None and not c:
                    options = within | ({""} if least == 0 else set())
                elif least >= 1:
                    more = [*c, _one([trigrams(t) for t in sorted(within)]) if within is not None else None]
                    if within is not None and not c and len(within) == 1 and least <= 8:
                        exact = {x + next(iter(within)) * least for x in exact}
                        more = []
            elif name == "AT":
                continue
            conditions.extend(more)
            if options is None or len(exact) * len(options) > most:
                flush()
                if options is not None:
                    exact = options
            else:
                exact = {x + y for x in exact for y in options}
        if ends:
            return exact, conditions
        conditions.append(_one([trigrams(x) for x in sorted(exact)]))
        return None, conditions

    exact, conditions = walk(parser.parse(pattern))
    return _all([*conditions, _one([trigrams(x) for x in sorted(exact)]) if exact is not None else None])


def names(query: Query) -> set[str]:
    return set() if query is None else {query} if isinstance(query, str) else set().union(*(names(p) for p in query[1]))


def holds(query: Query, present: Column) -> Column:
    """Whether an array of trigrams satisfies a query."""
    if isinstance(query, str):
        return F.array_contains(present, query)
    parts = [holds(p, present) for p in query[1]]
    out = parts[0]
    for p in parts[1:]:
        out = out & p if query[0] == "and" else out | p
    return out


def postings(keyed: DataFrame, wanted: list[str]) -> DataFrame:
    """The inverted index: a row for each trigram that a query names and each id whose lower-cased text holds it.

    Long lists, such as those of a trigram that is in a third of the texts, are spread over tasks by id as well.
    """
    low = F.lower("text")
    present = F.array_compact(F.array(*[F.when(F.contains(F.col("low"), F.lit(t)), F.lit(t)) for t in wanted]))
    lists = keyed.filter("id is not null").select("id", low.alias("low")).select("id", F.explode(present).alias("trigram"))
    return cut(lists.repartition("trigram", F.pmod(F.xxhash64("id"), F.lit(64))), "postings")


def candidates(index: DataFrame, queries: dict[int, Query]) -> DataFrame:
    """Intersect postings: by id, the numbers of the rules whose queries it satisfies."""
    # A rule is decided by the trigrams present at an id; there are never more of those than the queries name.
    present = index.groupBy("id").agg(F.collect_set("trigram").alias("present"))
    passed = F.array_compact(F.array(*[F.when(holds(q, F.col("present")), F.lit(k)) for k, q in queries.items()]))
    return present.select("id", passed.alias("rules")).filter(F.size("rules") > 0)


def _searched(docs: DataFrame, rules: tuple[Rule, ...], id_col: str, text_col: str, carry: bool) -> DataFrame:
    """``id``, ``text``, ``carry`` (the whole row, if asked for) and ``spans``, a struct of arrays by kind."""
    queries = {k: q for k, rule in enumerate(rules) if (q := trigram_query(rule.pattern)) is not None}
    wanted = sorted(set().union(*map(names, queries.values()))) if queries else []
    whole = F.struct(*docs.columns) if carry else F.lit(None).cast("boolean")
    keyed = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"), whole.alias("carry"))
    if wanted:
        keyed = keyed.join(candidates(postings(keyed_text(docs, id_col, text_col), wanted), queries), "id", "left")
    else:
        keyed = keyed.withColumn("rules", F.lit(None).cast("array<int>"))

    def spans(k: int, rule: Rule) -> Column:
        given = None
        if k in queries:
            given = F.col("id").isNull() | F.coalesce(F.array_contains("rules", k), F.lit(False))
        elif rule.least > 1 and rule.group == 0 and re.fullmatch(r"\[[^\]]+\]\+", rule.pattern):
            given = F.col("text").rlike(f"{rule.pattern[:-1]}{{{rule.least},}}")  # a run: its length can be asked for
        found = located(F.col("text"), rule.pattern, rule.group or None, given=given)
        kept = F.filter(found, lambda s: F.length(s["group" if rule.group else "value"]) >= rule.least) if rule.least > 1 else found
        return kept.alias(rule.kind)

    return keyed.select("id", "text", "carry", F.struct(*[spans(k, r) for k, r in enumerate(rules)]).alias("spans"))


def with_spans(docs: DataFrame, rules: tuple[Rule, ...] = BASE + ADDED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of all rules in whole texts: a row per input row with the id and ``spans``, a struct with an array for each kind.

    A rule's matches are leftmost and non-overlapping; those that its length limit fails are dropped and not retried.
    Null texts are empty. Rows without an id are not in the index and are searched with every rule; repeated ids share
    their postings. Other columns are ignored, whatever their names.
    """
    return _searched(docs, rules, id_col, text_col, carry=False).select(F.col("id").alias(id_col), "spans")


def digest_columns(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, the digest of their spans, and all spans as text."""
    base = {r.kind: F.col(f"spans.{r.kind}") for r in BASE}
    kinds = found.schema["spans"].dataType.names
    return found.select(
        id_col, *[F.size(base[k]).cast("long").alias(f"n_{k}") for k in base], F.sha2(F.encode(listed(base), "UTF-8"), 256).alias("base_sha256"),
        listed({k: F.col(f"spans.{k}") for k in kinds}).alias("spans"),
    )


def masked(docs: DataFrame, rules: tuple[Rule, ...] = BASE + ADDED, sign: str = "[SECRET]", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs``, with the spans of all rules replaced; overlapping spans become one sign. Null texts stay null."""
    found = _searched(docs, rules, id_col, text_col, carry=True)
    ends = lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))
    spans = F.array_sort(F.flatten(F.array(*[F.transform(F.col(f"spans.{r.kind}"), ends) for r in rules])))
    text = F.col("text")

    def step(acc: Column, s: Column) -> Column:
        piece = F.when(s["start"] >= acc["at"], F.concat(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(sign))).otherwise(F.lit(""))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["parts"], F.array(piece)).alias("parts"))

    clean = F.aggregate(
        F.col("all"), F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts")), step,
        lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substring(text, acc["at"] + 1, F.length(text))),
    )
    whole = found.withColumn("all", spans).withColumn("clean", F.when(F.size("all") > 0, clean).otherwise(F.col(f"carry.`{text_col}`")))
    return whole.select(*[F.col("clean").alias(c) if c == text_col else F.col(f"carry.`{c}`").alias(c) for c in docs.columns])
