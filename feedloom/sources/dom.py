"""A small DOM on the standard HTML parser, with the selectors that source configurations use."""

from __future__ import annotations

import re
from html.parser import HTMLParser

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_CLOSES = {"p": {"p"}, "li": {"li"}, "tr": {"tr", "td"}, "td": {"td"}, "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}
_STEP = re.compile(r"([a-zA-Z][\w-]*|\*)?((?:[.#][\w-]+|\[[\w:-]+(?:[*^$~]?=(?:\"[^\"]*\"|'[^']*'|[^\]]*))?\])*)")
_PART = re.compile(r"([.#])([\w-]+)|\[([\w:-]+)(?:([*^$~]?=)(?:\"([^\"]*)\"|'([^']*)'|([^\]]*)))?\]")


class Element:
    __slots__ = ("name", "attrs", "kids", "up")

    def __init__(self, name, attrs, up):
        self.name, self.attrs, self.kids, self.up = name, attrs, [], up

    def get(self, key):
        return self.attrs.get(key)

    def all(self):
        """This element's descendants in document order."""
        stack = list(reversed(self.kids))
        while stack:
            x = stack.pop()
            if isinstance(x, Element):
                yield x
                stack.extend(reversed(x.kids))

    def text(self, between: str = "") -> str:
        out, stack = [], list(reversed(self.kids))
        while stack:
            x = stack.pop()
            if isinstance(x, Element):
                stack.extend(reversed(x.kids))
            else:
                out.append(x)
        return between.join(out)

    def select(self, selector: str):
        steps = [_compiled(s) for s in selector.split(",")]
        return [e for e in self.all() if any(_matches(e, s, self) for s in steps)]

    def first(self, selector: str):
        return next(iter(self.select(selector)), None)


def _compiled(selector: str):
    out, child = [], False
    for token in selector.replace(">", " > ").split():
        if token == ">":
            child = True
            continue
        name, rest = _STEP.fullmatch(token).groups()
        out.append((child, name if name != "*" else None, [m.groups() for m in _PART.finditer(rest or "")]))
        child = False
    return out


def _simple(e: Element, name, parts) -> bool:
    if name and e.name != name.lower():
        return False
    for sign, word, key, op, *values in parts:
        if sign == ".":
            if word not in (e.get("class") or "").split():
                return False
        elif sign == "#":
            if e.get("id") != word:
                return False
        else:
            has, want = e.get(key), next((v for v in values if v is not None), "")
            if has is None or op and not {"=": has == want, "*=": want in has, "^=": has.startswith(want), "$=": has.endswith(want), "~=": want in has.split()}[op]:
                return False
    return True


def _matches(e: Element, steps, top: Element) -> bool:
    child, name, parts = steps[-1]
    if not _simple(e, name, parts):
        return False
    if len(steps) == 1:
        return True
    up = e.up
    while up is not None and up.name:
        if _matches(up, steps[:-1], top):
            return True
        if child:
            return False
        up = up.up
    return False


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.now = self.root = Element("", {}, None)

    def handle_starttag(self, tag, attrs):
        if self.now.name in _CLOSES.get(tag, ()):
            self.now = self.now.up
        new = Element(tag, {k: v or "" for k, v in reversed(attrs)}, self.now)
        self.now.kids.append(new)
        if tag not in _VOID:
            self.now = new

    def handle_endtag(self, tag):
        at = self.now
        while at.name and at.name != tag:
            at = at.up
        if at.name:
            self.now = at.up

    def handle_data(self, data):
        self.now.kids.append(data)


def parse(html: str) -> Element:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


def css_path(e: Element) -> str:
    """A short selector of an element: at most three levels, with two classes or the id."""
    out = []
    while e is not None and e.name not in ("", "html") and len(out) < 3:
        classes = (e.get("class") or "").split()[:2]
        out.append(e.name + ("." + ".".join(classes) if classes else f"#{e.get('id')}" if e.get("id") else ""))
        e = e.up
    return " > ".join(reversed(out))
