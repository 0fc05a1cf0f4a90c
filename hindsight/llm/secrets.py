"""Secret scans over a trigram inverted index.

From each rule's regular expression follows a Boolean query of trigrams: any
match must hold all trigrams of one of the query's alternatives (letters in
lower case). The index lists, for each trigram that some query asks for, the
texts that hold it; a text is read once to find all that it holds. Texts are dealt over segments of bounded size by their key,
so a posting list is an array within its segment; queries intersect and unite
these arrays. Candidates, and only they, are read again and verified with the
rule's expression. Rules without mandatory trigrams scan all texts.

Texts are indexed by 128-bit key, so copies are indexed and verified once.
Everything but the derivation of the queries is DataFrame functions.

Edge cases: null texts count as empty and have no spans; whole texts are
scanned; rows of equal texts get the same spans; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hindsight.llm.spans import with_spans
from hindsight.llm.work import stage, text_key

#: Texts in a segment of the index, about.
SEGMENT = 1024
#: Alternatives into which a rule's expression is spelled out before gaps take their place.
MOST_ALTERNATIVES = 256


@dataclass(frozen=True)
class Rule:
    """``pattern`` must mean the same to Java and Python; possessive quantifiers do."""

    name: str
    pattern: str
    holds: Callable[[Column], Column]
    base: bool = False


ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]++"""
VALUE = r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
RULES = [
    Rule("assign", ASSIGN, lambda v: F.length(F.regexp_replace(v, VALUE, "")) >= 8, base=True),
    Rule("access", r"AKIA[A-Z0-9]++", lambda v: F.length(v) >= 16, base=True),
    # Shorter runs fail anyway, and no run begins within another.
    Rule("hex", r"[0-9a-f]{32,}+", lambda v: F.lit(True), base=True),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----", lambda v: F.lit(True)),
    Rule("code_host", r"gh[opsu]_[A-Za-z0-9]{36,}+", lambda v: F.lit(True)),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}+", lambda v: F.lit(True)),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}+\.eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]+", lambda v: F.lit(True)),
]

#: A stretch of text that a match must hold in one piece, or None for a gap that may be anything.
Parts = tuple[str | None, ...]


#: What an expression is read by: characters, classes, groups, bars, repetitions (greedy, lazy or possessive).
TOKEN = re.compile(
    r"""\\x(?P<code>[0-9A-Fa-f]{2}) | \\(?P<escape>.) | \[(?P<set>\^?\]?(?:\\.|[^\]\\])*)\]
    | (?P<open>\()(?:\?(?P<mode>i?:|.))? | (?P<close>\)) | (?P<bar>\|)
    | (?P<times>[*+?]|\{(?P<least>[0-9]+)(?P<more>,(?P<most>[0-9]*))?\})[+?]? | (?P<any>[.^$]) | (?P<char>.)""",
    re.X | re.S,
)
#: Of classes only those of so few plain characters are spelled out.
MOST_CHARACTERS = 5


def spelled(pattern: str) -> list[Parts]:
    """Alternatives of mandatory strings and gaps that cover all matches of ``pattern``.

    One gap where the expression holds what isn't read here, such as look-around or references.
    """
    anything: list[Parts] = [(None,)]
    # A level for each open group: alternatives that ended, the one at hand, and its last item, which may be repeated.
    ended, sequence, last = [[]], [[()]], [[()]]

    def close_item() -> None:
        out = [a + b for a in sequence[-1] for b in last[-1]]
        sequence[-1], last[-1] = (out if len(out) <= MOST_ALTERNATIVES else anything), [()]

    for m in TOKEN.finditer(pattern):
        if m["times"]:
            once, t = last[-1], m["times"]
            least = int(m["least"]) if m["least"] else int(t == "+")
            if least:
                last[-1] = once if (m["least"], m["more"]) == ("1", None) else [a + (None,) for a in once]
            else:
                plain = t == "?" and len(once) == 1 and len(once[0]) == 1 and once[0][0]
                last[-1] = [(), *once] if plain else anything
            continue
        close_item()
        if m["open"]:
            if m["mode"] not in (None, ":", "i:"):
                return anything
            for stack, fresh in ((ended, []), (sequence, [()]), (last, [()])):
                stack.append(fresh)
        elif m["bar"]:
            ended[-1], sequence[-1] = ended[-1] + sequence[-1], [()]
        elif m["close"]:
            group = ended.pop() + sequence.pop()
            last.pop()
            last[-1] = group if len(group) <= MOST_ALTERNATIVES else anything
        elif m["set"] is not None:
            if "[" in m["set"] or "&&" in m["set"]:
                return anything
            few = len(m["set"]) <= MOST_CHARACTERS and not re.search(r"^\^|\\|-.", m["set"])
            last[-1] = [(c.lower(),) for c in m["set"]] if few else anything
        elif m["escape"]:
            if m["escape"].isalnum() and m["escape"] not in "dDwWsSbB":
                return anything
            last[-1] = anything if m["escape"].isalnum() else [(m["escape"],)]
        else:
            c = chr(int(m["code"], 16)) if m["code"] else m["char"]
            last[-1] = [(c.lower(),)] if c else anything
    close_item()
    return ended[-1] + sequence[-1]


def query(pattern: str) -> list[frozenset[str]]:
    """Trigram sets of which a matching text holds one wholly; empty if some match needs no trigram."""
    out = set()
    for parts in spelled(pattern):
        runs = "".join(p if p else "\0" for p in parts).split("\0")
        # Letters with other lower case forms are no trigrams: Spark's lower() and ours must agree.
        grams = frozenset(r[i : i + 3] for r in runs for i in range(len(r) - 2) if r[i : i + 3].isascii())
        if not grams:
            return []
        out.add(grams)
    return sorted((g for g in out if not any(o < g for o in out)), key=sorted)


#: Trigrams whose bits share a number.
BITS = 62


def held_grams(rows: DataFrame, grams: list[str]) -> DataFrame:
    """(key, doc_id, held): distinct texts that hold any of ``grams``, with the least id that has the text.

    ``held`` has a bit for each trigram, in numbers of ``BITS``: plain arithmetic that compiles into one pass, with
    the lower case taken once. Texts without any go after the aggregation: a filter before it would move below
    the projections and look for all trigrams again, in a lower case taken anew for each.
    """
    low = rows.select("key", "doc_id", F.lower("text").alias("low"))

    def bits(some: list[str]) -> Column:
        return reduce(lambda a, b: a.bitwiseOR(b), [F.when(F.contains("low", F.lit(g)), 1 << i).otherwise(0).cast("long") for i, g in enumerate(some)])

    numbers = {f"b{n}": bits(grams[n : n + BITS]) for n in range(0, len(grams), BITS)}
    each = low.select("key", "doc_id", *[c.alias(name) for name, c in numbers.items()]).groupBy("key")
    held = each.agg(F.min("doc_id").alias("doc_id"), *[F.bit_or(name).alias(name) for name in numbers])
    return held.where(reduce(or_, [F.col(name) != 0 for name in numbers])).select("key", "doc_id", F.array(*numbers).alias("held"))


def index(held: DataFrame, grams: list[str]) -> DataFrame:
    """(segment, gram, keys): the posting lists, segments being made so many that each holds about ``SEGMENT`` texts."""
    segments = max(1, -(-held.count() // SEGMENT))
    own = F.array_compact(
        F.array(*[F.when(F.get("held", F.lit(i // BITS)).bitwiseAND(F.lit(1 << i % BITS)) != 0, g) for i, g in enumerate(grams)])
    )
    entries = held.select("key", F.explode(own).alias("gram")).withColumn("segment", F.pmod(F.xxhash64("key"), F.lit(segments)))
    return entries.groupBy("segment", "gram").agg(F.collect_list("key").alias("keys"))


def candidates(postings: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """(key, rules): texts that a rule's trigram query lets through, with the names of those rules."""
    lists = postings.groupBy("segment").agg(F.map_from_entries(F.collect_list(F.struct("gram", "keys"))).alias("lists"))
    none = F.array().cast("array<binary>")
    posting = lambda g: F.coalesce(F.get(F.array(F.col("lists")[g]), F.lit(0)), none)
    found = {
        rule: reduce(F.array_union, [reduce(F.array_intersect, [posting(g) for g in sorted(grams)]) for grams in alternatives])
        for rule, alternatives in queries.items()
    }

    def named(rule: str, keys: Column) -> Column:
        return F.transform(keys, lambda k: F.struct(k.alias("key"), F.lit(rule).alias("rule")))

    each = [named(rule, keys) for rule, keys in found.items()]
    pairs = lists.select(F.explode(F.concat(*each)).alias("c")).select("c.key", "c.rule")
    return pairs.groupBy("key").agg(F.collect_set("rule").alias("rules"))


def scanned(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """``rows`` with ``spans``, an array of (start, place of the rule, end, kind, value) from ``text``."""
    rows = with_spans(rows, "text", {f"k{i}": r.pattern for i, r in enumerate(rules)})

    def of(i: int, rule: Rule) -> Column:
        true = F.filter(F.col(f"k{i}"), lambda s: rule.holds(s["value"]))
        return F.transform(
            true,
            lambda s: F.struct(
                s["start"].alias("start"), F.lit(RANK[rule.name]).alias("rank"), s["end"].alias("end"), F.lit(rule.name).alias("kind"), s["value"].alias("value")
            ),
        )

    return rows.withColumn("spans", F.concat(*[of(i, r) for i, r in enumerate(rules)])).drop(*[f"k{i}" for i in range(len(rules))])


RANK = {r.name: i for i, r in enumerate(RULES)}
SPANS = "array<struct<start:bigint,rank:int,end:bigint,kind:string,value:string>>"


def by_text(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """(doc_id, key, spans) of ``rows`` (doc_id, key, text)."""
    queries = {r.name: query(r.pattern) for r in rules}
    indexed, open_ = [r for r in rules if queries[r.name]], [r for r in rules if not queries[r.name]]
    # Rules without a query read every text where it lies. Without their texts, rows are narrow enough to be joined.
    narrow = scanned(rows, open_).withColumnRenamed("spans", "own").drop("text")
    if not indexed:
        return narrow.withColumnRenamed("own", "spans")
    grams = sorted({g for q in queries.values() for alternative in q for g in alternative})
    held = stage(held_grams(rows, grams), "held")
    wanted = candidates(index(held, grams), {r.name: queries[r.name] for r in indexed}).join(held.drop("held"), "key")
    # The others: only candidates' texts are kept, one of each key; found by id, which copies don't share.
    r, w = rows.alias("r"), stage(wanted, "candidates").alias("w")
    same = F.col("r.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("r.key") == F.col("w.key"))
    texts = r.join(w, same).select("w.key", "r.text", "w.rules").dropDuplicates(["key"])
    verified = scanned(texts, indexed).select("key", F.filter("spans", lambda s: F.array_contains("rules", s["kind"])).alias("found"))
    verified = stage(verified.where(F.size("found") > 0), "verified")
    spans = F.array_sort(F.concat("own", F.coalesce("found", F.array().cast(SPANS))))
    return narrow.join(verified, "key", "left").withColumn("spans", spans).drop("own", "found")


def find(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """(doc_id, spans) of every row: start, rank, end, kind and value, by start and then rule as listed."""
    text = F.coalesce("text", F.lit(""))
    return by_text(docs.select("doc_id", text.alias("text"), text_key(text).alias("key")), rules).select("doc_id", "spans")


def redact(docs: DataFrame, rules: list[Rule] = RULES, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every secret replaced by ``mark``, overlapping ones by one, and ``n_chars`` as it then is.

    Rows without secrets stay as they are.
    """
    key = text_key(F.coalesce("text", F.lit("")))
    found = by_text(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), key.alias("key")), rules)
    found = stage(found.where(F.size("spans") > 0).dropDuplicates(["key"]), "secrets")

    # Rows go through as one struct, so that no column of theirs clashes with ours.
    rows = docs.select(F.struct("*").alias("row_"), key.alias("key_"))
    joined = rows.join(found.select(F.col("key").alias("key_"), F.col("spans").alias("spans_")), "key_", "left")
    text = F.col("row_")["text"]

    def replaced(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        until = F.substring(text, (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int"))
        out = F.when(fresh, F.concat(state["out"], until, F.lit(mark))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), out.alias("out"))

    rest = lambda state: F.concat(state["out"], F.substring(text, (state["at"] + 1).cast("int"), F.length(text)))
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    dirty = F.col("spans_").isNotNull()
    clean = F.when(dirty, F.aggregate("spans_", begin, replaced, rest)).otherwise(text)
    joined = joined.select("row_", "spans_", clean.alias("text_"))
    new = {"text": F.col("text_")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(dirty, F.length("text_")).otherwise(F.col("row_")["n_chars"]).cast(docs.schema["n_chars"].dataType)
    return joined.select(*[new.get(c, F.col("row_")[c]).alias(c) for c in docs.columns])
