"""Secret scans through a trigram inverted index.

From each rule's regex a Boolean query over trigrams is derived that every match must
satisfy.  The index holds postings (trigram, document) for the trigrams these queries
name; intersecting them gives each rule's candidate documents, on which alone its regex
runs.  Rules without a mandatory trigram scan every text.  DataFrame functions only.

Matches come from ``regexp_extract_all`` and the texts between them from ``split`` with
the same pattern; running lengths of both give spans in code points.
"""

from __future__ import annotations

from itertools import product
from re import _constants as C, _parser
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from vigil.llm.store import boxed


class Rule(NamedTuple):
    kind: str
    pattern: str
    group: int = 0      # the group whose length must be at least ...
    least: int = 0      # ... this many characters; matches that fall short are dropped


#: the base rules, in the order in which their kinds are listed
BASE = (
    Rule("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
                   r"([A-Za-z0-9+/_.=-]+)", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    # runs are maximal, so a least length in the pattern drops the same ones
    Rule("hex", r"[0-9a-f]{16,}"),
)
RULES = BASE + (
    Rule("github", r"gh[opsru]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    # the key itself, through its END line; the BEGIN line alone if there is none
    Rule("private_key", r"-----BEGIN [A-Z ]{0,24}PRIVATE KEY-----"
                        r"(?:[A-Za-z0-9+/=,:.\x20\x09\x0A\x0D-]*?-----END [A-Z ]{0,24}PRIVATE KEY-----)?"),
)

#: strings a literal run may stand for, characters a class may stand for, trigrams of one
#: string that its query names
MAX_STRINGS, MAX_CLASS, MAX_GRAMS = 16, 8, 3


def _class_chars(items) -> list[str] | None:
    """Lower-cased members of a character class, None if too many or negated."""
    out: set[str] = set()
    for op, arg in items:
        if op is C.LITERAL:
            out.add(chr(arg).lower())
        elif op is C.RANGE and arg[1] - arg[0] < 4 * MAX_CLASS:
            out.update(chr(c).lower() for c in range(arg[0], arg[1] + 1))
        else:
            return None
    return sorted(out) if len(out) <= MAX_CLASS else None


def _runs(tree) -> list[list[str]]:
    """Literal runs of a parsed regex: each match contains, for every run, one of its
    strings (lower case)."""
    done: list[list[str]] = []
    run = [""]

    def close() -> None:
        nonlocal run
        if run != [""]:
            done.append(run)
        run = [""]

    def append(options: list[str]) -> None:
        nonlocal run
        if len(run) * len(options) > MAX_STRINGS:
            close()
        if len(options) <= MAX_STRINGS:
            run = sorted({a + b for a, b in product(run, options)})

    def exact(part) -> list[str] | None:
        """All strings of a small finite part, else None."""
        if len(part) == 0:
            return [""]
        own = [""]
        for op, arg in part:
            if op is C.LITERAL:
                more = [chr(arg).lower()]
            elif op is C.IN:
                more = _class_chars(arg)
            elif op is C.SUBPATTERN:
                more = exact(arg[3])
            elif op is C.BRANCH:
                options = [exact(p) for p in arg[1]]
                more = None if None in options else sorted({x for o in options for x in o})
            elif op in (C.MAX_REPEAT, C.MIN_REPEAT) and arg[1] <= 6:
                one = exact(arg[2])
                more = None if one is None else sorted(
                    {"".join(x) for n in range(arg[0], arg[1] + 1)
                     for x in product(one, repeat=n)}) if len(one) ** arg[1] <= 64 else None
            else:
                more = None
            if more is None or len(own) * len(more) > MAX_STRINGS:
                return None
            own = sorted({a + b for a, b in product(own, more)})
        return own

    for op, arg in tree:
        if (strings := exact([(op, arg)])) is not None:
            append(strings)
        elif op is C.SUBPATTERN:
            close()
            done += _runs(arg[3])
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT) and arg[0] >= 1:
            close()
            done += _runs(arg[2])
            close()
        else:
            close()
    close()
    return done


def trigram_query(pattern: str) -> list[list[list[str]]]:
    """AND over runs of OR over strings of AND over trigrams; empty if none is mandatory."""
    query = []
    for run in _runs(_parser.parse(pattern)):
        if all(len(s) >= 3 for s in run):
            clause = []
            for s in run:
                grams = sorted({s[i:i + 3] for i in range(len(s) - 2)}, key=s.index)
                step = max(1, (len(grams) - 1) // max(1, MAX_GRAMS - 1))
                clause.append(grams[::step][:MAX_GRAMS])
            query.append(clause)
    return query


def _grams(rules) -> list[str]:
    return sorted({g for r in rules for clause in trigram_query(r.pattern) for s in clause
                   for g in s})


def trigram_index(df: DataFrame, rules=RULES, *, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Postings ``gram, doc_id`` of the trigrams that the rules' queries name, found in the
    lower-cased text."""
    grams = _grams(rules)
    low = df.select(F.col(f"`{id_col}`").alias("doc_id"),
                    F.lower(F.col(f"`{text_col}`")).alias("__low"))
    found = F.array(*[F.when(F.contains("__low", F.lit(g)), F.lit(g)) for g in grams])
    return low.select("doc_id", F.explode(F.array_compact(found)).alias("gram")) \
        if grams else low.select("doc_id", F.lit("").alias("gram")).where("false")


def candidates(index: DataFrame, rules=RULES) -> DataFrame:
    """``doc_id, rules``: the kinds whose trigram queries the document's postings satisfy.
    Postings of a document meet in one row by partial aggregation of bit sets."""
    grams = _grams(rules)
    place = {g: i for i, g in enumerate(grams)}
    words = (len(grams) + 61) // 62
    code = F.element_at(F.create_map(*[x for g in grams for x in (F.lit(g), F.lit(place[g]))]),
                        F.col("gram"))
    coded = index.select("doc_id", code.alias("__g"))
    bits = [F.bit_or(F.when(F.floor(F.col("__g") / 62) == w,
                            F.expr("shiftleft(1L, cast(__g % 62 AS int))")).otherwise(
        F.lit(0).cast("long"))).alias(f"__w{w}") for w in range(words)]
    has = lambda g: F.col(f"__w{place[g] // 62}").bitwiseAND(
        F.lit(1 << (place[g] % 62))) != 0

    def satisfied(query) -> Column:
        every = F.lit(True)
        for clause in query:
            some = F.lit(False)
            for s in clause:
                each = F.lit(True)
                for g in s:
                    each = each & has(g)
                some = some | each
            every = every & some
        return every

    kinds = F.array_compact(F.array(*[F.when(satisfied(q), F.lit(r.kind)) for r in rules
                                      if (q := trigram_query(r.pattern))]))
    return (coded.groupBy("doc_id").agg(*bits).select("doc_id", kinds.alias("rules"))
            .where(F.size("rules") > 0))


def _spans(rule: Rule, order: int, text: Column, group: Column, parts: Column,
           whole: Column) -> Column:
    """Array of ``start, ord, end, kind`` from matches and the texts between them."""
    lengths = F.transform(whole, lambda m: F.length(m))
    between = F.transform(parts, lambda p: F.length(p))
    empty = F.array().cast("array<struct<start:int,ord:int,end:int,kind:string>>")
    steps = F.arrays_zip(lengths.alias("m"), F.slice(between, F.lit(1), F.size(whole)).alias("p"),
                         F.transform(group, lambda g: F.length(g) >= rule.least).alias("ok"))
    start = lambda acc, x: acc["at"] + x["p"]
    return F.aggregate(
        steps, F.struct(F.lit(0).alias("at"), empty.alias("out")),
        lambda acc, x: F.struct(
            (start(acc, x) + x["m"]).alias("at"),
            F.when(x["ok"], F.concat(acc["out"], F.array(F.struct(
                start(acc, x).alias("start"), F.lit(order).alias("ord"),
                (start(acc, x) + x["m"]).alias("end"), F.lit(rule.kind).alias("kind")))))
            .otherwise(acc["out"]).alias("out")),
        lambda acc: acc["out"])


def scan(df: DataFrame, rules=RULES, *, id_col: str = "doc_id", text_col: str = "text",
         spans: str = "spans") -> DataFrame:
    """``df`` with ``spans``: array of ``start, ord, end, kind`` of all secrets, by start,
    then rule order (code points, end exclusive; leftmost, non-overlapping per kind).

    Candidates are joined back by id; texts are shuffled once for that.  Rows that share an
    id share their postings, a superset that verification settles row by row; null ids
    likewise.  A null text counts as empty (no spans); an empty table stays empty.  Other
    columns are carried; one named as ``spans`` is replaced.
    """
    found = candidates(trigram_index(df, rules, id_col=id_col, text_col=text_col), rules).select(
        F.col("doc_id").alias("__id"), F.col("rules").alias("__rules"))
    box, own = boxed(df, {spans.lower()})
    text = F.col("__text")
    out = (df.select(box, F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("__text"),
                     F.col(f"`{id_col}`").alias("__own"))
           .join(found, F.col("__own").eqNullSafe(F.col("__id")), "left")
           .select("__row", "__text", "__rules"))
    # one projection per step, so that no expression is evaluated twice
    whole, group, parts = {}, {}, {}
    for k, r in enumerate(rules):
        hit = F.lit(True) if not trigram_query(r.pattern) else F.coalesce(
            F.array_contains("__rules", r.kind), F.lit(False))
        whole[f"__m{k}"] = F.when(hit, F.regexp_extract_all(text, F.lit(r.pattern), 0))
    out = out.select("__row", "__text", *[c.alias(n) for n, c in whole.items()])
    for k, r in enumerate(rules):
        some = F.size(f"__m{k}") > 0
        parts[f"__p{k}"] = F.when(some, F.split(text, r.pattern, -1))
        group[f"__g{k}"] = F.when(some, F.regexp_extract_all(text, F.lit(r.pattern), r.group)
                                  if r.group else F.col(f"__m{k}"))
    out = out.select("__row", *whole, *[c.alias(n) for n, c in {**parts, **group}.items()])
    empty = F.array().cast("array<struct<start:int,ord:int,end:int,kind:string>>")
    each = [F.when(F.size(f"__m{k}") > 0, _spans(r, k, text, F.col(f"__g{k}"),
                                                 F.col(f"__p{k}"), F.col(f"__m{k}")))
            .otherwise(empty) for k, r in enumerate(rules)]
    return out.select(*own, F.array_sort(F.concat(*each)).alias(spans))


def as_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column) -> Column:
    """The text with each span (overlapping ones merged) replaced by ``[kind]``."""
    piece = lambda at, to: F.substring(text, at + 1, to - at)
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(
        spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] >= acc["at"], F.concat(
                acc["out"], piece(acc["at"], s["start"]), F.lit("["), s["kind"], F.lit("]")))
            .otherwise(acc["out"]).alias("out")),
        lambda acc: F.concat(acc["out"], piece(acc["at"], F.length(text)))))
