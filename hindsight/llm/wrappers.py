"""Main text of web pages by wrappers that are inferred for each host.

A wrapper is a union-free regular expression over a host's pages. Pages become
balanced token streams of block elements and texts, and each stream is aligned
with what the wrapper knows: at every element the children's tokens are walked
in order, a token that is new there becomes an optional group, tokens that come
again or in another order fold into a repeated group, and a text that differs
becomes a slot. So a token is there once in each element, a wrapper is as large
as a host's templates are various, not as its pages are many, and two wrappers
align as two pages do.

Tasks infer wrappers of the pages they read. Those of a host meet in two steps,
first in ``PARTS`` parts, so a host that holds a third of all pages is no task's
burden: what meets is one wrapper a task, never pages. A wrapper says which of
its groups are the article, by element, by the words in class and id, by the
share of text in links, and by texts that are the same on all pages. That is
its plan, a few hundred bytes that are joined to the host's pages by host, where
AQE may split a host. Each page is then read by its plan.

Within a text block white space is one blank, ``<br>`` included. Elements nested
deeper than ``DEEPEST`` count as their parent. Headings of an article belong to it.

Edge cases: null html is empty text, null url or one without ``://`` belongs to
the host without a name; a page without any text outside of menus and the like
has an empty text; cut-off markup ends where the page ends; a page alone on its
host is its own wrapper; repeated rows are read each; an empty table gives none;
extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
import html as references
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hindsight.llm.work import stage

# Elements by what HTML makes of them.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements whose content is no text of the page.
OPAQUE = set("script style title textarea noscript iframe template svg canvas select button object audio video xmp noembed noframes".split())
#: Of these an end tag is looked for to the end of the page; the others without one are empty.
RAW = set("script style title textarea iframe xmp noembed noframes".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: What a starting element closes, and where the search for it ends.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir", "td", "th"}),
    "dt": ({"dt", "dd"}, {"dl", "td", "th"}),
    "dd": ({"dt", "dd"}, {"dl", "td", "th"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
}
#: These close only the nearest one.
NEAREST = {"li", "dt", "dd"}
SCOPES = {"td", "th", "table", "caption"}
# Elements and words in class, id and role that stand for what isn't the article.
BESIDES = set("head nav footer aside form menu dialog search fieldset legend".split())
NAMED = set(
    "nav navbar navigation menu breadcrumb breadcrumbs footer sidebar aside widget widgets ad ads advert adverts advertisement adsense banner "
    "sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription "
    "signup login share sharing social related recommended recommendations comment comments commentlist disqus reply replies respond form search "
    "pagination pager toolbar copyright paywall masthead topbar complementary contentinfo".split()
)
MAIN = set("article content main post entry story body text".split())
#: Elements that are judged by such words, and those whose words tell groups apart.
JUDGED = set("div section aside ul ol dl article main header center figure details table".split())
TELLING = JUDGED | set("nav footer form p td span".split())

#: Parts a page at its markup; around that: the opaque element, slash, name and attributes, null where there is none.
MARKUP = re.compile(
    r"<!--(?:.*?-->|.*)"
    rf"|<({'|'.join(sorted(RAW))})(?=[\s/>])[^>]*(?:>.*?(?:</\1\b[^>]*(?:>|\Z)|\Z)|\Z)"
    rf"|<({'|'.join(sorted(OPAQUE - RAW))})(?=[\s/>])[^>]*(?:(?<=/)>|>.*?</\2\b[^>]*(?:>|\Z)|>|\Z)"
    r"|<(/?)([a-z][^\s/>]*)([^>\"']*+(?:\"[^\"]*\"[^>\"']*+|'[^']*'[^>\"']*+)*+(?=>)|[^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
ATTRIBUTES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
DEEPEST = 200
#: An element with more kinds of children than this keeps only those words of theirs that say what they are.
KINDS = 64
#: A text that so many different pages have alike is the template's.
ALIKE = 3
#: A task hands on what it has when its wrappers hold so many nodes.
NODES = 200_000
PARTS = 32

OPEN, CLOSE, TEXT = 0, 1, 2


def kind_of(name: str, attributes: str) -> str:
    """Element and the words that tell its kind, such as ``div.content.post``."""
    if "=" not in attributes or name not in TELLING:
        return name
    words = {w.lower() for found in ATTRIBUTES.findall(attributes) for w in WORDS.findall("".join(found))}
    return ".".join([name, *sorted(words)])


def bare(kind: str) -> str:
    name, *words = kind.split(".")
    return ".".join([name, *(w for w in words if w in NAMED or w in MAIN)])


def tokens(page: str) -> list[tuple]:
    """The balanced stream of (OPEN, kind), (CLOSE,) and (TEXT, text, characters of it in links)."""
    out: list[tuple] = []
    stack: list[str] = []
    said: list[str] = []
    linked, link = 0, False

    def end_block() -> None:
        nonlocal linked
        text = " ".join("".join(said).split())
        if text:
            out.append((TEXT, text, min(linked, len(text))))
        said.clear()
        linked = 0

    def close(depth: int) -> None:
        """Close what is open from ``depth`` on."""
        nonlocal link
        link = False
        if said:
            end_block()
        out.extend([(CLOSE,)] * (len(stack) - depth))
        del stack[depth:]

    pieces = MARKUP.split(page)
    for text, closing, name, attributes in zip(pieces[::6], [*pieces[3::6], None], [*pieces[4::6], None], [*pieces[5::6], None]):
        if text:
            text = references.unescape(text) if "&" in text else text
            said.append(text)
            if link:
                linked += len(" ".join(text.split()))
        if not name:
            continue
        name = name.lower()
        if name not in BLOCKS:
            if stack and stack[-1] == "head" and not closing and name not in VOID:
                close(len(stack) - 1)
            if name == "a":
                link = not closing
            elif name == "br":
                said.append(" ")
            elif name == "hr" and said:
                end_block()
            continue
        if closing:
            depth = len(stack) - 1
            while depth >= 0 and stack[depth] != name and (stack[depth] not in SCOPES or name in CLOSES or name in SCOPES):
                depth -= 1
            if depth >= 0 and stack[depth] == name:
                close(depth)
            elif name == "p" and said:
                end_block()
            continue
        if said:
            end_block()
        if stack and (stack[-1] in ("p", "head") or name in HEADINGS and stack[-1] in HEADINGS):
            close(len(stack) - 1)
        if name in CLOSES:
            closed, scope = CLOSES[name]
            depth, last = len(stack) - 1, None
            while depth >= 0 and stack[depth] not in scope:
                if stack[depth] in closed:
                    last = depth
                    if name in NEAREST:
                        break
                depth -= 1
            if last is not None:
                close(last)
        if len(stack) < DEEPEST:
            stack.append(name)
            out.append((OPEN, kind_of(name, attributes)))
    if said:
        end_block()
    out.extend([(CLOSE,)] * len(stack))
    return out


class Group:
    """What a wrapper knows of an element or a text: how often it is there, how its children follow each other."""

    __slots__ = ("n", "held", "many", "rows", "kids", "chars", "linked", "text", "known")

    def __init__(self):
        self.n = self.held = self.chars = self.linked = 0
        self.many = False
        self.rows: list[list[str]] = []  # children in order; several in one row are a repeated group
        self.kids: dict[str, Group] = {}
        self.text: str | None = None  # what a text says everywhere, hashed; "" once it differs
        self.known: list[str] | None = None

    def align(self, sequence: list[str]) -> None:
        """Take in the children of one element."""
        kids = self.kids
        shape = []
        for kind in sequence:
            if shape and kind == shape[-1]:
                kids[kind].many = True
            else:
                shape.append(kind)
        for kind in set(shape):
            kids[kind].held += 1
        if shape == self.known:
            return
        self.known = shape
        rows: list[list[str]] = []
        where: dict[str, int] = {}
        for kind in shape:
            if kind in where:  # again: a repeated group since it was there first
                self._fold(rows, where[kind], len(rows) - 1)
                where = {k: i for i, row in enumerate(rows) for k in row}
            else:
                where[kind] = len(rows)
                rows.append([kind])
        self.order(rows)
        if len(kids) > KINDS:
            self.generalise()

    @staticmethod
    def _fold(rows: list[list[str]], first: int, last: int) -> None:
        rows[first : last + 1] = [list(dict.fromkeys(k for row in rows[first : last + 1] for k in row))]

    def order(self, rows: list[list[str]]) -> None:
        """Align another order of children: what is new is inserted, what contradicts folds into one group."""
        at = -1
        for row in rows:
            hits = [i for i, mine in enumerate(self.rows) if any(k in mine for k in row)]
            if not hits:
                at += 1
                self.rows.insert(at, list(row))
                continue
            first, last = min(hits), max(hits)
            if first < at:
                last = max(last, at)
            self._fold(self.rows, first, last)
            self.rows[first] = list(dict.fromkeys([*self.rows[first], *row]))
            at = first

    def generalise(self) -> None:
        """Too many kinds of children: only telling words are kept, equal kinds align."""
        kids, rows = self.kids, self.rows
        if all(kind == bare(kind) for kind in kids):
            return
        self.kids, self.rows, self.known = {}, [], None
        for kind, kid in kids.items():
            if bare(kind) in self.kids:
                self.kids[bare(kind)].merge(kid)
                self.kids[bare(kind)].many = True
            else:
                self.kids[bare(kind)] = kid
        where: dict[str, int] = {}
        folded: list[list[str]] = []
        for row in rows:
            folded.append(list(dict.fromkeys(bare(k) for k in row)))
            seen = [where[k] for k in folded[-1] if k in where]
            if seen:
                self._fold(folded, min(seen), len(folded) - 1)
            where = {k: i for i, r in enumerate(folded) for k in r}
        self.rows = folded

    def find(self, kind: str) -> Group | None:
        return self.kids.get(kind) or self.kids.get(bare(kind))

    def merge(self, other: Group) -> None:
        """Align two wrappers of the same element."""
        self.n, self.held = self.n + other.n, self.held + other.held
        self.chars, self.linked = self.chars + other.chars, self.linked + other.linked
        self.many |= other.many
        if other.text is not None:
            self.text = other.text if self.text in (None, other.text) else ""
        for kind, kid in other.kids.items():
            if kind in self.kids:
                self.kids[kind].merge(kid)
            else:
                self.kids[kind] = kid
        self.known = None
        self.order(other.rows)
        if len(self.kids) > KINDS:
            self.generalise()

    def dump(self) -> list:
        return [self.n, self.held, int(self.many), self.chars, self.linked, self.text, self.rows, {k: g.dump() for k, g in self.kids.items()}]

    @staticmethod
    def load(held: list) -> Group:
        group = Group()
        group.n, group.held, many, group.chars, group.linked, group.text, group.rows, kids = held
        group.many = bool(many)
        group.kids = {k: Group.load(g) for k, g in kids.items()}
        return group

    def size(self) -> int:
        return 1 + sum(kid.size() for kid in self.kids.values())


def short_hash(text: str) -> str:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()


class Wrapper:
    """The expression of a host and hashes of up to ``ALIKE`` different pages."""

    def __init__(self, root: Group | None = None, pages: set[str] | None = None):
        self.root, self.pages = root or Group(), pages or set()

    def add(self, page: str) -> int:
        """Align one page; how many nodes that has added."""
        root = self.root
        open_: list[tuple[Group, list[str]]] = [(root, [])]
        root.n += 1
        whole = hashlib.blake2b(digest_size=8) if len(self.pages) < ALIKE else None
        added = 0
        for token in tokens(page):
            group, sequence = open_[-1]
            if token[0] == CLOSE:
                group.align(sequence)
                open_.pop()
                continue
            kind = token[1] if token[0] == OPEN else "#"
            if kind not in group.kids:
                kind = bare(kind) if bare(kind) in group.kids or len(group.kids) >= KINDS else kind
                if kind not in group.kids:
                    group.kids[kind] = Group()
                    added += 1
            sequence.append(kind)
            kid = group.kids[kind]
            kid.n += 1
            if token[0] == OPEN:
                open_.append((kid, []))
                continue
            if whole:
                whole.update(token[1].encode("utf-8", "surrogatepass"))
            kid.chars, kid.linked = kid.chars + len(token[1]), kid.linked + token[2]
            if kid.text != "":
                said = short_hash(token[1])
                kid.text = said if kid.text in (None, said) else ""
        root.align(open_[0][1])
        if whole:
            self._seen({whole.hexdigest()})
        return added

    def _seen(self, pages: set[str]) -> None:
        self.pages = set(sorted(self.pages | pages)[:ALIKE])

    def merge(self, other: Wrapper) -> None:
        self.root.merge(other.root)
        self._seen(other.pages)

    def dumps(self) -> str:
        return json.dumps([sorted(self.pages), self.root.dump()], separators=(",", ":"), ensure_ascii=False)

    @staticmethod
    def loads(text: str) -> Wrapper:
        pages, root = json.loads(text)
        return Wrapper(Group.load(root), set(pages))

    def expression(self) -> str:
        """The regular expression: ``?`` is optional, ``+`` repeated, ``_`` a slot and ``=`` a text that is always the same."""

        def of(kind: str, group: Group, parent: Group, several: bool) -> str:
            inner = ("=" if group.text and len(self.pages) > 1 else "_") if kind == "#" else f"<{kind}>{row(group)}</{kind.split('.')[0]}>"
            mark = "+" if group.many and not several else ""
            optional = "?" if group.held < parent.n else ""
            return f"({inner}){mark or optional}" if mark or optional else inner

        def row(group: Group) -> str:
            return "".join(of(r[0], group.kids[r[0]], group, False) if len(r) == 1 else f"({''.join(of(k, group.kids[k], group, True) for k in r)})+" for r in group.rows)

        return row(self.root)

    def plan(self) -> dict:
        """Which groups are what: ``{kind: [mark, plan of its children]}``, only where something is said.

        Marks: ``x`` isn't the article, ``a`` and ``m`` are article and main
        element, ``s`` is nothing unless there is no such element.
        """
        whole = self._free(self.root)

        def alike(group: Group) -> bool:
            """All texts in it are the template's."""
            if len(self.pages) < ALIKE:
                return False
            own = group.kids.get("#")
            return (own is None or bool(own.text)) and all(alike(kid) for kind, kid in group.kids.items() if kind != "#")

        def of(group: Group, inside: bool) -> dict:
            said = {}
            for kind, kid in group.kids.items():
                if kind == "#":
                    continue
                name, *words = kind.split(".")
                free = self._free(kid)
                mark = ""
                if name in BESIDES or (name == "header" and not inside):
                    mark = "x"
                elif name in JUDGED and NAMED & set(words) and (name != "main" and 2 * free <= whole or "comments" in words):
                    mark = "x"
                elif name in ("div", "section", "ul", "ol") and kid.chars + free and not kid.many and alike(kid):
                    mark = "x" if inside else "s"
                elif not inside and name in ("article", "main") or "main" in words and name in JUDGED:
                    mark = "a" if name == "article" else "m"
                elif not inside and name in ("ul", "ol", "div", "table", "section") and 2 * self._linked(kid) > self._all(kid):
                    mark = "s"
                below = {} if mark == "x" else of(kid, inside or mark == "a")
                if mark or below:
                    said[kind] = [mark, below]
            return said

        return of(self.root, False)

    @classmethod
    def _all(cls, group: Group) -> int:
        return group.chars + sum(cls._all(kid) for kid in group.kids.values())

    @classmethod
    def _linked(cls, group: Group) -> int:
        return group.linked + sum(cls._linked(kid) for kid in group.kids.values())

    @classmethod
    def _free(cls, group: Group) -> int:
        """Characters outside of links, head and menus."""
        return group.chars - group.linked + sum(cls._free(kid) for kind, kid in group.kids.items() if kind.split(".")[0] not in BESIDES)


def article(page: str, plan: dict) -> str:
    """Text blocks of a page that its host's plan calls the article; without such, of main; without, what is nothing else."""
    found: dict[str, list[str]] = {"a": [], "m": [], "": []}
    none: dict = {}
    state, at = "", plan
    above: list[tuple[str, dict]] = []
    for token in tokens(page):
        if token[0] == TEXT:
            if state in found:
                found[state].append(token[1])
                if state == "a" and any(s == "m" for s, _ in above):
                    found["m"].append(token[1])
        elif token[0] == CLOSE:
            state, at = above.pop()
        else:
            above.append((state, at))
            mark, below = at.get(token[1]) or at.get(bare(token[1])) or ("", none)
            at = below
            if state != "x" and mark and not (mark == "s" and state):
                state = mark if mark in "xs" or state in ("", "s") or mark == "a" else state
    return "\n".join(found["a"] or found["m"] or found[""])


def hosts_of(pages: DataFrame, *columns: str) -> DataFrame:
    """The named columns, ``html`` without nulls, and ``host_name``."""
    after = F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return pages.select(*columns, F.coalesce("html", F.lit("")).alias("page"), F.lower(after).alias("host_name"))


def _merged(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Align the wrappers of equal keys; rows of a key follow each other, so one wrapper is held at a time."""

    def merge(batches):
        last, held = None, None
        for batch in batches:
            out = []
            for host, text in zip(batch["host_name"], batch["wrapper"]):
                if host != last:
                    if held is not None:
                        out.append((last, held.dumps()))
                    last, held = host, Wrapper.loads(text)
                else:
                    held.merge(Wrapper.loads(text))
            yield pd.DataFrame(out, columns=["host_name", "wrapper"])
        if held is not None:
            yield pd.DataFrame([(last, held.dumps())], columns=["host_name", "wrapper"])

    return rows.repartition(*keys).sortWithinPartitions(*keys, "wrapper").mapInPandas(merge, "host_name string, wrapper string")


def wrappers(pages: DataFrame) -> DataFrame:
    """(host_name, wrapper, expression, plan) of each host."""

    def infer(batches) -> Iterator[pd.DataFrame]:
        held: dict[str, Wrapper] = {}
        nodes = 0
        for batch in batches:
            for host, page in zip(batch["host_name"], batch["page"]):
                if host not in held:
                    held[host] = Wrapper()
                nodes += held[host].add(page)
            if nodes > NODES:
                yield pd.DataFrame([(h, w.dumps()) for h, w in held.items()], columns=["host_name", "wrapper"])
                held, nodes = {}, 0
        yield pd.DataFrame([(h, w.dumps()) for h, w in held.items()], columns=["host_name", "wrapper"])

    def planned(batches):
        for batch in batches:
            known = [Wrapper.loads(w) for w in batch["wrapper"]]
            yield batch.assign(expression=[w.expression() for w in known], plan=[json.dumps(w.plan(), separators=(",", ":")) for w in known])

    read = hosts_of(pages).mapInPandas(infer, "host_name string, wrapper string")
    parts = _merged(read.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(PARTS))), ["part", "host_name"])
    return _merged(parts, ["host_name"]).mapInPandas(planned, "host_name string, wrapper string, expression string, plan string")


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every page."""
    plans = stage(wrappers(pages), "wrappers").select(F.col("host_name").alias("host_"), "plan")
    rows = hosts_of(pages, "page_id", "url")
    rows = rows.join(plans, rows["host_name"] == plans["host_"], "left").select("page_id", "url", "page", "plan")

    def read(batches):
        known: dict[str, dict] = {}
        for batch in batches:
            texts = []
            for page, plan in zip(batch["page"], batch["plan"]):
                if plan not in known:
                    known = {} if len(known) >= 10_000 else known
                    known[plan] = json.loads(plan)
                texts.append(article(page, known[plan]))
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    ids = pages.schema["page_id"].dataType.simpleString()
    return rows.mapInPandas(read, f"page_id {ids}, url string, text string, n_chars long")
