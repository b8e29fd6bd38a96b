"""Pages as trees of blocks: a forgiving reader of HTML, and the features of its nodes."""

from __future__ import annotations

import html
import re

import numpy as np

#: Element names by what they mean for the tree.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template noscript title textarea iframe xmp noembed noframes".split())
DROPPED = frozenset("script style template noscript title iframe object svg math canvas audio video map head".split())
BLOCKS = frozenset(
    "html body address article aside blockquote button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup legend li main menu nav ol optgroup option p pre search section select summary table tbody td textarea "
    "tfoot th thead tr ul".split())
CLOSES_P = BLOCKS - frozenset("html body button caption dd dt option optgroup legend td th tr tbody thead tfoot summary figcaption li select textarea".split())
#: An element that is begun inside another of its set ends that one, up to the given bound.
ENDS = {
    "li": (frozenset(["li"]), frozenset("ul ol menu".split())),
    "dd": (frozenset("dd dt".split()), frozenset(["dl"])), "dt": (frozenset("dd dt".split()), frozenset(["dl"])),
    "td": (frozenset("td th".split()), frozenset("tr table".split())), "th": (frozenset("td th".split()), frozenset("tr table".split())),
    "tr": (frozenset("tr td th".split()), frozenset(["table"])), "option": (frozenset(["option"]), frozenset(["select"])),
    "tbody": (frozenset("tbody thead tfoot tr td th".split()), frozenset(["table"])),
    "tfoot": (frozenset("tbody thead tfoot tr td th".split()), frozenset(["table"])),
}
KINDS = {k: i for i, k in enumerate(
    "#text p h1 h2 h3 h4 h5 h6 li ul ol dl dd dt blockquote pre table tr td th figure figcaption div section article main body html nav header footer "
    "aside form button fieldset address details summary menu select option textarea".split())}
#: Parts of class, id and role names by what they speak for.
TOKENS = {
    "body_like": "article content post entry story text main body prose blog news page single maincontent",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs topbar toolbar tabs pager pagination skip toc",
    "head": "header masthead banner logo branding hero site top",
    "foot": "footer foot copyright colophon legal bottom contentinfo",
    "side": "sidebar side aside widget rail complementary related recommended popular trending more teaser teasers links also",
    "advert": "ad ads adv advert advertisement adsense sponsor sponsored promo promoted promotion dfp banner commercial outbrain taboola",
    "notice": "cookie cookies consent gdpr notice notification alert popup modal overlay banner paywall disclaimer dialog toast privacy",
    "reader": "comment comments reply replies respond discussion disqus thread reactions review reviews commentlist commenter",
    "form": "form login signin signup search subscribe subscription newsletter contact input register",
    "share": "share sharing social follow tags tag meta byline author date print tools actions",
    "hidden": "hidden invisible sr only offscreen collapse d none",
}
GROUP_OF: dict[str, int] = {}
for _i, _words in enumerate(TOKENS.values()):
    for _w in _words.split():
        GROUP_OF[_w] = GROUP_OF.get(_w, 0) | 1 << _i
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:[\s=]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
NAMES = re.compile(r"""(?:^|\s)(?:class|id|role|aria-label|data-component|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
TAG = re.compile(r"""<!--|<!\[CDATA\[|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""")


def token_groups(attrs: str) -> int:
    """Bits of the groups that class, id and role names speak for."""
    bits = 0
    for m in NAMES.finditer(attrs):
        for part in PART.findall(m[1] or m[2] or m[3] or ""):
            bits |= GROUP_OF.get(part.lower(), 0)
    return bits


class Page:
    """Nodes in page order: block elements and runs of text between their ends.

    name, parent, depth, groups (bits of attribute names), hidden; of runs:
    text (white space as one space), characters inside links, and words.
    """

    def __init__(self, source: str):
        self.name, self.parent, self.depth, self.groups, self.hidden = [], [], [], [], []
        self.text: dict[int, str] = {}
        self.linked: dict[int, int] = {}
        self._read(source)

    def _node(self, name: str, parent: int, groups: int = 0, hidden: bool = False) -> int:
        self.name.append(name)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        self.groups.append(groups)
        self.hidden.append(hidden)
        return len(self.name) - 1

    def _read(self, source: str) -> None:
        stack: list[tuple[str, int]] = [("html", self._node("html", -1))]  # open elements; inline ones have their block's node
        run: list[str] = []
        linked = 0
        links = drop = 0  # open links and dropped elements
        opened: dict[str, int] = {}  # open elements by name: the stack is searched only for what is there

        def end_run() -> None:
            nonlocal run, linked
            if run:
                text = " ".join("".join(run).split())
                if text:
                    i = self._node("#text", stack[-1][1])
                    self.text[i], self.linked[i] = text, min(linked, len(text))
                run, linked = [], 0

        def close(upto: int) -> None:
            nonlocal links, drop
            while len(stack) > upto:
                name = stack[-1][0]
                if name in BLOCKS or len(stack) > 1 and stack[-1][1] != stack[-2][1]:
                    end_run()
                links -= name == "a"
                drop -= name in DROPPED
                opened[name] = opened.get(name, 0) - 1
                stack.pop()

        def push(name: str, node: int) -> None:
            stack.append((name, node))
            opened[name] = opened.get(name, 0) + 1

        def add(text: str) -> None:
            nonlocal linked
            if text and not drop:
                text = html.unescape(text) if "&" in text else text
                run.append(text)
                if links:
                    linked += len(text)

        at, n = 0, len(source)
        while at < n:
            m = TAG.search(source, at)
            if m is None:
                add(source[at:])
                break
            if m.start() > at:
                add(source[at:m.start()])
            at = m.end()
            name = m[2] or m[5]
            if name is None:
                if m[0] == "<!--":
                    end = source.find("-->", max(at - 2, 0))
                    at = n if end < 0 else end + 3
                elif m[0] == "<![CDATA[":
                    end = source.find("]]>", at)
                    at = n if end < 0 else end + 3
                continue
            name = name.lower()
            if m[1] or m[4]:  # an end tag
                if name == "br":
                    add(" ")
                for k in range(len(stack) - 1, 0, -1) if opened.get(name) else ():
                    if stack[k][0] == name:
                        close(k)
                        break
                    if name not in BLOCKS and stack[k][0] in BLOCKS and name != "a":
                        break  # a stray end of an inline element stays inside its block
                continue
            attrs = m[3] if m[2] else m[6]
            if name in VOID:
                if name in ("br", "hr"):
                    if name == "hr":
                        end_run()
                    add(" ")
                continue
            if name == "html" or name == "body" and opened.get(name):
                continue
            if name in BLOCKS and opened.get("head"):
                close(next(k for k, s in enumerate(stack) if s[0] == "head"))
            if name in CLOSES_P and opened.get("p"):
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == "p":
                        close(k)
                        break
                    if stack[k][0] in BLOCKS:
                        break
            if name in ENDS and any(opened.get(x) for x in ENDS[name][0]):
                ended, bound = ENDS[name]
                cut = None
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] in bound:
                        break
                    if stack[k][0] in ended:
                        cut = k
                if cut is not None:
                    close(cut)
            if name == "a" and links:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == "a":
                        if all(s[0] not in BLOCKS for s in stack[k:]):
                            close(k)
                        break
            if attrs.endswith("/") and name not in BLOCKS and name not in RAW:
                continue
            if name in RAW:
                end = re.compile(f"</{re.escape(name)}", re.I).search(source, at)
                stop = end.start() if end else n
                if name == "textarea" and not drop:
                    end_run()
                    push(name, self._node(name, stack[-1][1], token_groups(attrs), bool(HIDDEN.search(attrs))))
                    add(source[at:stop])
                    close(len(stack) - 1)
                at = n if not end else (source.find(">", stop) + 1 or n)
                continue
            if name in BLOCKS:
                end_run()
                push(name, self._node(name, stack[-1][1], token_groups(attrs), bool(HIDDEN.search(attrs))))
            elif (hidden := bool(HIDDEN.search(attrs))) or (name not in ("a",) and token_groups(attrs) & MARKED):
                # An inline element that speaks for itself is a node, and its text a run of its own.
                end_run()
                push(name, self._node("div", stack[-1][1], token_groups(attrs), hidden))
                links += name == "a"
            else:
                push(name, stack[-1][1])
                links += name == "a"
            drop += name in DROPPED
        close(0)


#: Groups for which an inline element becomes a node: adverts, notices, hidden text.
MARKED = sum(1 << i for i, k in enumerate(TOKENS) if k in ("advert", "notice", "hidden"))
GROUPS = list(TOKENS)
INSIDE = ("article", "main", "nav", "header", "footer", "aside", "form", "li")
FEATURES = (
    ["kind", "is_text", "depth", "chars", "words", "link_share", "commas", "stops", "subtree_chars", "subtree_nodes", "density", "subtree_link_share",
     "page_share", "siblings", "same_siblings", "place", "before_chars", "after_chars", "parent_chars", "parent_link_share", "parent_kind", "hidden",
     "page_place", "headings", "paragraphs"]
    + [f"own_{g}" for g in GROUPS] + [f"up_{g}" for g in GROUPS] + [f"in_{x}" for x in INSIDE])


def features(pages: list[Page]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all nodes of pages, each node's parent (-1: none), and the first node of each page."""
    sizes = np.array([len(p.name) for p in pages], np.int64)
    first = np.cumsum(sizes) - sizes
    total = int(sizes.sum())
    parent = np.full(total, -1, np.int64)
    kind, depth, groups = np.zeros(total, np.int64), np.zeros(total), np.zeros(total, np.int64)
    hidden = np.zeros(total, bool)
    chars, words, linked, commas, stops = (np.zeros(total) for _ in range(5))
    for p, f in zip(pages, first, strict=True):
        n = len(p.name)
        own = np.array(p.parent, np.int64)
        parent[f:f + n] = np.where(own >= 0, own + f, -1)
        kind[f:f + n] = [KINDS.get(x, len(KINDS)) for x in p.name]
        depth[f:f + n], groups[f:f + n], hidden[f:f + n] = p.depth, p.groups, p.hidden
        for i, t in p.text.items():
            chars[f + i], words[f + i], linked[f + i] = len(t), t.count(" ") + 1, p.linked[i]
            commas[f + i], stops[f + i] = t.count(","), t.count(".")
    page = np.repeat(np.arange(len(pages)), sizes)
    sub = {k: v.copy() for k, v in (("chars", chars), ("linked", linked), ("commas", commas), ("stops", stops), ("words", words))}
    nodes = np.ones(total)
    heads = np.isin(kind, [KINDS[f"h{i}"] for i in range(1, 7)]).astype(float)
    paras = (kind == KINDS["p"]).astype(float)
    up, hid = groups.copy(), hidden.copy()
    inside = {x: (kind == KINDS[x]) for x in INSIDE}
    order = np.argsort(depth, kind="stable")
    cuts = np.searchsorted(depth[order], np.arange(int(depth.max()) + 2)) if total else np.zeros(1, np.int64)
    levels = [order[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    for level in levels[1:]:  # downward
        up[level] |= up[parent[level]]
        hid[level] |= hid[parent[level]]
        for v in inside.values():
            v[level] |= v[parent[level]]
    for level in reversed(levels[1:]):  # upward
        for v in (*sub.values(), nodes, heads, paras):
            np.add.at(v, parent[level], v[level])
    up_parent = np.where(parent >= 0, up[parent], 0)
    # Siblings: rows in order of (parent, place).
    by = np.lexsort((np.arange(total), parent))
    pp = parent[by]
    new = np.concatenate([[True], pp[1:] != pp[:-1]]) if total else np.zeros(0, bool)
    group = np.cumsum(new) - 1
    count = np.bincount(group) if total else np.zeros(0)
    start = np.flatnonzero(new)
    siblings, place = np.zeros(total), np.zeros(total)
    siblings[by] = count[group] if total else 0
    place[by] = (np.arange(total) - start[group]) / np.maximum(1, count[group] - 1) if total else 0
    before, after = np.zeros(total), np.zeros(total)
    if total:
        s = sub["chars"][by]
        before[by[1:]] = np.where(new[1:], 0, s[:-1])
        after[by[:-1]] = np.where(new[1:], 0, s[1:])
    pair = parent * 64 + np.minimum(kind, 63)
    _, back, same = np.unique(pair, return_inverse=True, return_counts=True)
    whole = np.bincount(page, chars, len(pages))[page]
    upto = np.cumsum(chars) - chars
    upto = upto - upto[first][page] if total else upto
    par = np.where(parent >= 0, parent, np.arange(total))
    share = lambda a, b: a / np.maximum(1, b)
    columns = [
        kind, kind == 0, depth, np.log1p(sub["chars"] * (kind == 0)), np.log1p(sub["words"]), share(linked, chars), share(sub["commas"], sub["words"]),
        share(sub["stops"], sub["words"]), np.log1p(sub["chars"]), np.log1p(nodes), np.log1p(sub["chars"] / nodes), share(sub["linked"], sub["chars"]),
        share(sub["chars"], whole), np.log1p(siblings), same[back] / np.maximum(1, siblings), place, np.log1p(before), np.log1p(after),
        np.log1p(sub["chars"][par]), share(sub["linked"][par], sub["chars"][par]), np.where(parent >= 0, kind[par], 63), hid,
        share(upto, whole), np.log1p(heads), np.log1p(paras)]
    columns += [(groups >> i) & 1 for i in range(len(GROUPS))] + [(up_parent >> i) & 1 for i in range(len(GROUPS))]
    columns += [inside[x] for x in INSIDE]
    return np.stack([np.asarray(c, np.float32) for c in columns], axis=1) if total else np.zeros((0, len(FEATURES)), np.float32), parent, first
