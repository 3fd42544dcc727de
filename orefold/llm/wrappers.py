"""Main text of web pages by union-free wrapper inference.

A wrapper is a union-free regular expression over the token stream of one host,
written as a tree: elements, text slots, ``?`` for what some pages lack and ``+`` for
what repeats. The pages of a host are folded into it one after the other: child lists
are aligned, neighbours of one kind or a period of kinds collapse into a repeated
group, tokens without a partner become optional, and text that differs turns a
constant into a slot. Folding wrappers into each other works the same way, so every
task folds the pages it has, and the partial wrappers of a host meet in rounds of
``FAN_IN``, however many pages the host has. A wrapper grows with the variety of the
markup, not with the pages.

The wrapper says where the article is: in the elements that declare it (``article``,
``main``, ...), else in the smallest element that holds most of the host's
variable text. From there all blocks of a page are taken but for menus, forms,
notices, adverts, comments and the like, and, where no element declares the
article, but for text that stands at the same place of every page. A form, or an element of which
only a part of a name says that it is no article (``has-sidebar``), is layout if it
holds most of the host's variable text. Inside the article a paragraph, heading or
other element of text goes by its names only if the wrapper finds the same text there
on all pages (three at least), and so does a container of which only a part of a name is
telling. A page that would come out empty is read once more without forms and names.

Reading a page takes time in proportion to its length, whatever its markup: where a
tag's end was looked for in vain, it is not looked for again, and elements nested
deeper than ``DEPTH`` are counted, not kept.

Defined cases: null and empty pages give an empty text; a null url is a host of its
own; markup that is not closed or not opened is repaired as browsers do; rows may
repeat; an empty table gives no rows; whole pages are read, of any length; extra
columns pass through ``keep``, whatever their names.
"""

from __future__ import annotations

import html
import json
import re
from difflib import SequenceMatcher
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orefold.llm.scratch import Scratch
from orefold.llm.shipping import ship
from orefold.llm.words import SLICE_BYTES

FAN_IN = 256
# Share of the variable text that the article's element must hold.
SHARE = 0.7
# Pages from which on equal text counts as part of the template.
SUPPORT = 3
# Wrappers up to this size go to every task by way of the driver; beyond it pages and wrappers meet by host.
BROADCAST_BYTES = 32 << 20
# Pages of a host that one task takes then.
GROUP_PAGES = 2_000
MAX_PERIOD = 4
# Elements nested deeper than this are merged into the one that holds them.
DEPTH = 100

_OPEN = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9:-]*)")
_STOP = re.compile(r"[>\"']")
# Elements whose content is no text of the page.
_RAW = {t: re.compile(rf"</{t}\s*>", re.IGNORECASE) for t in "script style noscript template textarea svg iframe title".split()}
_ATTRIBUTE = re.compile(r"([A-Za-z_:-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACE = re.compile(r"\s+")
_DIGITS = re.compile(r"[0-9]+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul button select option label".split()
)
# What an opening tag closes without saying so.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_IN_P = BLOCKS - {"button", "select", "option", "label", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "html", "head", "body"}
_APART = frozenset("head nav footer aside form button select option menu dialog label".split())
_NAMES = frozenset(
    "ad ads adsense advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay newsletter"
    " subscribe subscription signup login sidebar side-bar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar comment comments discussion disqus"
    " respond replies related recommended share sharing social widget toolbar pagination pager paywall skip search".split()
)
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
_MAIN = "@"
_OUT = "!"
_SOFT = "~"
_MAYBE = "?"
# Inside an article these hold its text, whatever they are called, unless the wrapper says otherwise.
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th tr caption figcaption".split())
_TALK = frozenset("comment comments discussion disqus respond replies".split())


def _label(tag: str, attrs: str, inside: bool, by_name: bool = True) -> str:
    """Tag and classes; ``!`` before what is not part of an article, ``~`` if the wrapper may say otherwise, ``?`` if it must say so first, ``@`` before what declares one."""
    if not attrs.strip(" /\t\r\n\f"):
        named, role, classes = [], "", []
        hidden = declared = False
    else:
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attrs)}
        role = found.get("role", "").lower()
        classes = _DIGITS.sub("", found.get("class", "").lower()).split()
        named = [*classes, *found.get("id", "").lower().split()]
        hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()
        declared = role in ("main", "article") or found.get("itemprop", "").lower() == "articlebody"
    article = tag in ("article", "main") or declared
    words = set(named) if article else {part for name in named for part in (name, *re.split(r"[-_]+", name))}
    if inside:
        words -= {"header", "masthead"}
    bad = _NAMES & words if by_name and tag not in ("html", "body") else frozenset()
    name = ".".join([tag, *sorted(set(classes))])
    if inside and bad and not article and not (hidden or role in _ROLES or tag in _APART) and (tag in _PROSE or bad.isdisjoint(named)):
        return _MAYBE + name
    apart = (tag in _APART and tag != "form") or (tag == "header" and not inside) or hidden or role in _ROLES or not bad.isdisjoint(_TALK.union(named))
    soft = bad or (by_name and tag == "form")
    return _OUT + name if apart else _SOFT + name if soft else _MAIN + name if article else name


def _tokens(page: str):
    """Tags of a page as (start, end, whether it closes, name, attributes); comments and raw elements have no name."""
    ends: dict[int, int] = {}  # where the tag ends that is still open, outside quotes, at a place
    stop_from = stop_at = -1  # the first of > " ' from one place on stands at the other
    closing = True  # whether there may be a > further on

    def tag_end(at: int) -> int:
        nonlocal stop_from, stop_at
        passed = []
        while at not in ends:
            passed.append(at)
            if not stop_from <= at <= stop_at:
                found = _STOP.search(page, at)
                stop_from, stop_at = at, found.start() if found else len(page)
            if stop_at == len(page):
                end = -1
                break
            if page[stop_at] == ">":
                end = stop_at
                break
            close = page.find(page[stop_at], stop_at + 1)
            at = close + 1 if close >= 0 else stop_at + 1
        else:
            end = ends[at]
        ends.update(dict.fromkeys(passed, end))
        return end

    at = page.find("<")
    while at >= 0:
        end, tag = -1, None
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            end = len(page) if end < 0 else end + 3
        elif page.startswith(("<!", "<?"), at):
            end = page.find(">", at) + 1 if closing else 0
            closing, end = end > 0, end or -1
        else:
            tag = _OPEN.match(page, at)
            if tag:
                end = tag_end(tag.end()) + 1 or -1
        if end < 0:  # no tag: the sign is text
            at = page.find("<", at + 1)
            continue
        name = tag[2].lower() if tag else ""
        if tag and name in _RAW and not tag[1]:
            found = _RAW[name].search(page, end)
            end, name = found.end() if found else len(page), ""
        yield at, end, bool(tag and tag[1]), name, page[tag.end() : end - 1] if name else ""
        at = page.find("<", end)


def parse(page: str, by_name: bool = True) -> list:
    """The page as a tree of ``[label, children]``, text being ``(text,)``; inline markup dissolves."""
    root: list = ["", []]
    path = [root]
    tags = [""]
    articles, paragraphs = [0], [0]  # how many of them are open, by depth
    text: list[str] = []

    def flush() -> None:
        if text:
            joined = _SPACE.sub(" ", html.unescape("".join(text))).strip()
            if joined:
                path[-1][1].append((joined,))
            text.clear()

    def close(to: int) -> None:
        flush()
        deeper.clear()
        del path[to:], tags[to:], articles[to:], paragraphs[to:]

    done = 0
    deeper: dict[str, int] = {}  # open elements below ``DEPTH``, by tag
    for start, end, closes, tag, attrs in _tokens(page):
        if start > done:
            text.append(page[done:start])
        done = end
        if not tag:
            continue
        if tag not in BLOCKS:
            if tag in ("br", "img", "input"):
                text.append(" ")
            continue
        if closes and deeper.get(tag):
            flush()
            deeper[tag] -= 1
            continue
        if closes:
            for i in range(len(tags) - 1, 0, -1):
                if tags[i] == tag:
                    close(i)
                    break
            else:
                flush()
            continue
        flush()
        closed = _CLOSES.get(tag)
        if closed:
            for i in range(len(tags) - 1, 0, -1):
                if tags[i] in ("ul", "ol", "dl", "table", "select", "menu"):
                    break
                if tags[i] in closed:
                    close(i)
                    break
        if paragraphs[-1] and tag in _IN_P:
            close(len(tags) - 1 - tags[::-1].index("p"))
        if tag == "hr":
            continue
        if len(path) >= DEPTH:  # deeper markup counts as part of the element there
            if tag not in ("p", "li", "dt", "dd", "option", "td", "th", "tr"):  # these close by themselves
                deeper[tag] = deeper.get(tag, 0) + 1
            continue
        label = _label(tag, attrs, articles[-1] > 0, by_name)
        if label[:1] == _MAIN:  # an element around the article is no side matter, whatever its name
            for x in path:
                if x[0][:1] == _SOFT or (x[0][:1] == _OUT and x[0][1:].split(".")[0] not in _APART | {"header"}):
                    x[0] = x[0][1:]
        node = [label, []]
        path[-1][1].append(node)
        path.append(node)
        tags.append(tag)
        articles.append(articles[-1] + (label[:1] == _MAIN))
        paragraphs.append(paragraphs[-1] + (tag == "p"))
    text.append(page[done:])
    flush()
    return root


# A wrapper node: [label, optional, repeated, pages, text mass, hashes of texts that all pages have there, whether
# any page has others, children]. A group of several kinds that repeat has the label "(...)".
L, OPT, REP, PAGES, MASS, SAME, SLOT, KIDS = range(8)


def _leaf(text: str) -> list:
    return ["#", False, False, 1, len(text), [hash_text(text)], False, []]


def hash_text(text: str) -> int:
    return xxhash.xxh64_intdigest(text)


def of_page(tree: list) -> list:
    """The wrapper of one page."""
    kids = [_leaf(x[0]) if len(x) == 1 else of_page(x) for x in tree[1]]
    return [tree[0], False, False, 1, 0, [], False, collapse(kids)]


def collapse(kids: list) -> list:
    """Periods of kinds that follow one another become one repeated group."""
    for size in range(1, MAX_PERIOD + 1):
        labels = [k[L] for k in kids]
        out, i = [], 0
        while i < len(kids):
            n = 1
            while labels[i + n * size : i + (n + 1) * size] == labels[i : i + size] and i + (n + 1) * size <= len(kids) and "#" not in labels[i : i + size]:
                n += 1
            if n == 1:
                out.append(kids[i])
                i += 1
                continue
            group = kids[i] if size == 1 else [f"({'|'.join(labels[i : i + size])})", False, False, 1, 0, [], False, kids[i : i + size]]
            for j in range(1, n):
                at = i + j * size
                again = kids[at] if size == 1 else [group[L], False, False, 1, 0, [], False, kids[at : at + size]]
                group = fold(group, again, same_page=True)
            group[REP] = True
            out.append(group)
            i += n * size
        kids = out
    return kids


def fold(a: list, b: list, same_page: bool = False) -> list:
    """The wrapper of all that either matches; both have one label."""
    pages = max(a[PAGES], b[PAGES]) if same_page else a[PAGES] + b[PAGES]
    x, y = set(a[SAME]), set(b[SAME])
    slot = a[SLOT] or b[SLOT] or (not same_page and x != y)
    return [a[L], a[OPT] or b[OPT], a[REP] or b[REP], pages, a[MASS] + b[MASS], sorted(x | y if same_page else x & y), slot, align(a[KIDS], b[KIDS], same_page)]


def _skipped(node: list) -> list:
    return [node[L], True, *node[REP:]]


def align(a: list, b: list, same_page: bool) -> list:
    x, y = [k[L] for k in a], [k[L] for k in b]
    if x == y:
        return [fold(p, q, same_page) for p, q in zip(a, b)]
    out = []
    for kind, i, j, k, m in SequenceMatcher(None, x, y, autojunk=False).get_opcodes():
        if kind == "equal":
            out += [fold(p, q, same_page) for p, q in zip(a[i:j], b[k:m])]
        else:
            out += [_skipped(n) for n in a[i:j]] + [_skipped(n) for n in b[k:m]]
    # a mismatch can leave two of one kind side by side: that is one repeated element
    merged: list = []
    for node in out:
        if merged and merged[-1][L] == node[L]:
            merged[-1] = fold(merged[-1], node, same_page)
            merged[-1][REP] = True
        else:
            merged.append(node)
    return merged


def expression(node: list) -> str:
    """The wrapper in the usual notation of regular expressions."""
    if node[L] == "#":
        return "#slot" if node[SLOT] else "#text"
    inner = " ".join(expression(k) for k in node[KIDS])
    mark = {(False, False): "", (True, False): "?", (False, True): "+", (True, True): "*"}[node[OPT], node[REP]]
    return f"<{node[L]}>{inner}</>{mark}" if node[L][:1] != "(" else f"({inner}){mark}"


def _apart(label: str, opened: frozenset | None) -> bool:
    """Whether an element is no part of an article; ``opened`` has those that are (None: all that may be)."""
    return label[:1] == _OUT or (label[:1] in (_SOFT, _MAYBE) and opened is not None and label not in opened)


def _mass(node: list, variable: bool, opened: frozenset | None) -> int:
    if _apart(node[L], opened):
        return 0
    own = node[MASS] if node[L] == "#" and (not variable or node[SLOT]) else 0
    return own + sum(_mass(k, variable, opened) for k in node[KIDS])


def _declares(node: list, opened: frozenset) -> bool:
    return node[L][:1] == _MAIN or (not _apart(node[L], opened) and any(_declares(k, opened) for k in node[KIDS]))


def _inner(node: list) -> list:
    return [g for k in node[KIDS] for g in (k[KIDS] if k[L][:1] == "(" else [k])]


def _layout(wrapper: list) -> frozenset:
    """Elements set apart by form or name that hold most of the text."""
    variable = _mass(wrapper, True, None) > 0
    whole, node, opened = _mass(wrapper, variable, None), wrapper, set()
    while True:
        heavy = [k for k in _inner(node) if k[L] != "#" and _mass(k, variable, None) >= SHARE * whole > 0]
        if not heavy:
            return frozenset(opened)
        node = heavy[0]
        if node[L][:1] == _SOFT:
            opened.add(node[L])


def _path_to_article(wrapper: list, opened: frozenset) -> tuple[str, ...]:
    variable = _mass(wrapper, True, opened) > 0
    path, node = [wrapper[L]], wrapper
    whole = _mass(wrapper, variable, opened)
    while True:
        heavy = [k for k in _inner(node) if k[L] != "#" and not k[REP] and _mass(k, variable, opened) >= SHARE * whole > 0]
        if not heavy:
            return tuple(path)
        node = heavy[0]
        path.append(node[L])


def _place(path: str, label: str) -> str:
    return f"{path}>{label}"


def _template(node: list, path: str = "") -> set:
    """Places and hashes of texts that all pages have there."""
    if node[L] == "#":
        return {(path, h) for h in node[SAME]} if node[PAGES] >= SUPPORT else set()
    inner = path if node[L][:1] == "(" else _place(path, node[L])  # a group is no element of its own
    return set().union(*[_template(k, inner) for k in node[KIDS]])


def _in_doubt(node: list) -> dict[str, bool]:
    """Elements that only the wrapper can set apart: whether one of them varies, or too few pages have it to tell."""
    out: dict[str, bool] = {}
    if node[L][:1] == _MAYBE:
        out[node[L]] = node[PAGES] < SUPPORT or _varies(node)
    for kid in node[KIDS]:
        for label, content in _in_doubt(kid).items():
            out[label] = out.get(label, False) or content
    return out


def _varies(node: list) -> bool:
    return node[SLOT] or any(_varies(k) for k in node[KIDS])


@lru_cache(maxsize=512)
def _plan(wrapper: str):
    """What the wrapper says: (declared, path to the article, hashes of template text, elements that are layout)."""
    node = json.loads(wrapper)
    opened = _layout(node) | {label for label, content in _in_doubt(node).items() if content}
    if _declares(node, opened):
        return True, (), frozenset(), opened
    path = _path_to_article(node, opened)
    return False, path, frozenset(_template(node)) if _mass(node, True, opened) else frozenset(), opened


def _texts(node, template, opened, place: str = "") -> list[str]:
    """Texts of an element, but for those of the template at their place; ``place`` is that of the element around it."""
    if len(node) == 1:
        return [] if template and (place, hash_text(node[0])) in template else [node[0]]
    if _apart(node[0], opened):
        return []
    inner = _place(place, node[0])
    return [t for k in node[1] for t in _texts(k, template, opened, inner)]


def _declared(node, opened) -> list:
    if len(node) == 1 or _apart(node[0], opened):
        return []
    return [node] if node[0][:1] == _MAIN else [n for k in node[1] for n in _declared(k, opened)]


def _along(node, path) -> list:
    if len(node) == 1 or node[0] != path[0]:
        return []
    return [node] if len(path) == 1 else [n for k in node[1] for n in _along(k, path[1:])]


def _around(path) -> str:
    """The place of the element around the one that ``path`` leads to."""
    place = ""
    for label in path[:-1]:
        place = _place(place, label)
    return place


def main_text(page: str, wrapper: str) -> str:
    """The blocks of the article, one per line."""
    tree = parse(page)
    declared, path, template, opened = _plan(wrapper)
    found = _declared(tree, opened)
    around = ""
    if not found and not declared:
        found, around = _along(tree, path), _around(path)
    if not found:  # a page unlike its host's others speaks for itself
        template = frozenset()
        own = of_page(tree)
        opened = opened | _layout(own) | _in_doubt(own).keys()
        found = _along(tree, _path_to_article(own, opened))
    texts = [t for n in found for t in _texts(n, template, opened, around)]
    if not texts and not template:  # nothing is left: forms and names do not count
        tree, opened = parse(page, by_name=False), frozenset()
        found = _declared(tree, opened) or _along(tree, _path_to_article(of_page(tree), opened))
        texts = [t for n in found for t in _texts(n, template, opened)]
    return "\n".join(texts)


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1))


_PARTIAL = "w_host string, w_part long, w_wrapper string"


def _fold_pages(batches):
    """Per host, the wrapper of the pages this task has."""
    part = TaskContext.get().partitionId()
    found: dict[str, list] = {}
    for batch in batches:
        for name, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            one = of_page(parse(page))
            found[name] = fold(found[name], one) if name in found else one
    names = list(found)
    yield pa.RecordBatch.from_arrays(
        [pa.array(names, type=pa.string()), pa.array([part] * len(names), type=pa.int64()), pa.array([json.dumps(found[n]) for n in names], type=pa.string())],
        names=["w_host", "w_part", "w_wrapper"],
    )


def _fold_wrappers(frame):
    out = None
    for w in frame["w_wrapper"]:
        one = json.loads(w)
        out = one if out is None else fold(out, one)
    return frame.iloc[:1].assign(w_part=frame["w_part"].iloc[0] // FAN_IN, w_wrapper=json.dumps(out))


def infer(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """``w_host`` and ``w_wrapper``, the wrapper of all pages of each host."""
    ship(pages.sparkSession)
    scratch = Scratch(pages.sparkSession)
    source = pages.select(host(F.col(url)).alias("w_host"), F.coalesce(F.col(page), F.lit("")).alias("w_page"))
    partial = scratch.keep(source.mapInArrow(_fold_pages, _PARTIAL), "wrappers")
    while (partial.agg(F.max("w_part").alias("m")).first()["m"] or 0) > 0:
        ordered = partial.groupBy("w_host", F.floor(F.col("w_part") / FAN_IN).alias("w_next"))
        folded = scratch.keep(ordered.applyInPandas(_fold_wrappers, _PARTIAL), "wrappers")
        scratch.drop(partial)
        partial = folded
    return partial.select("w_host", "w_wrapper")


def _texts_of(batch: pa.RecordBatch, wrapper_of):
    """The batch without its last two columns, site and page, and with ``w_text``; pages are taken a few megabytes at a time."""
    sites, pages = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
    start = 0
    while start < batch.num_rows:
        stop, size = start, 0
        while stop < batch.num_rows and size < SLICE_BYTES:
            size += len(pages[stop].as_py() or "")
            stop += 1
        texts = [main_text(p, wrapper_of(s)) if p else "" for s, p in zip(sites[start:stop].to_pylist(), pages[start:stop].to_pylist())]
        rest = batch.slice(start, stop - start).columns[:-2]
        yield pa.RecordBatch.from_arrays([*rest, pa.array(texts, type=pa.string())], names=[*batch.schema.names[:-2], "w_text"])
        start = stop


def extract(pages: DataFrame, keep: list[str], url: str = "url", page: str = "html") -> DataFrame:
    """``keep`` and ``w_text``, the main text of every page."""
    wrappers = infer(pages, url, page)
    size, hosts = wrappers.agg(F.sum(F.length("w_wrapper") + F.length("w_host")), F.count(F.lit(1))).first()
    source = pages.select(*[F.col(f"`{c}`") for c in keep], host(F.col(url)).alias("w_site"), F.coalesce(F.col(page), F.lit("")).alias("w_page"))
    schema = T.StructType([*source.schema.fields[:-2], T.StructField("w_text", T.StringType())])
    if (size or 0) + 100 * hosts <= BROADCAST_BYTES:
        shared = pages.sparkSession.sparkContext.broadcast({r.w_host: r.w_wrapper for r in wrappers.collect()})

        def run(batches):
            for batch in batches:
                yield from _texts_of(batch, shared.value.__getitem__)

        return source.mapInArrow(run, schema)

    # many wrappers: each visits the groups that its host's pages are dealt to, a wrapper once a group
    groups = F.greatest(F.lit(1), F.ceil(F.col("w_pages") / GROUP_PAGES))
    counts = source.groupBy(F.col("w_site").alias("w_of")).agg(F.count(F.lit(1)).alias("w_pages")).select("w_of", groups.cast("int").alias("w_groups"))
    visits = wrappers.join(counts, F.col("w_host") == F.col("w_of")).withColumn("w_group", F.explode(F.sequence(F.lit(0), F.col("w_groups") - 1)))
    dealt = source.join(counts, F.col("w_site") == F.col("w_of")).withColumn("w_group", F.pmod(F.monotonically_increasing_id(), F.col("w_groups")).cast("int"))

    def together(own: pa.Table, wrapper: pa.Table) -> pa.Table:
        text = wrapper["w_wrapper"][0].as_py() if len(wrapper) else None
        made = [part for batch in own.combine_chunks().to_batches() for part in _texts_of(batch, lambda _: text)]
        return pa.Table.from_batches(made, schema=None if made else pa.schema([]))

    sided = dealt.select(*[F.col(f"`{c}`") for c in keep], "w_site", "w_page", "w_group").groupBy("w_site", "w_group")
    visits = visits.select("w_host", "w_group", "w_wrapper").groupBy("w_host", "w_group")

    def cogrouped(own: pa.Table, wrapper: pa.Table) -> pa.Table:
        return together(own.drop_columns(["w_group"]), wrapper)

    return sided.cogroup(visits).applyInArrow(cogrouped, schema)
