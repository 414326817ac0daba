"""The visibility rules of a page's own style sheets.

Only what hides text counts: ``display`` and ``visibility`` of rules with type,
class and id selectors, alone or joined by descendant and child combinators,
in the cascade's order (importance, specificity, place).  Rules of ``@media``
blocks count where the block is for the screen without further conditions;
selectors with attributes, pseudo-classes or sibling combinators are left out,
as a static reader cannot tell when they hold.
"""

from __future__ import annotations

import re

_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
_DECLARATION = re.compile(r"(?:^|[;{\s])(display|visibility)\s*:\s*([a-zA-Z-]+)\s*(!\s*important)?", re.I)
_COMPOUND = re.compile(r"(?:\*|([a-zA-Z][\w-]*))?((?:[.#][\w-]+)*)")
_PART = re.compile(r"([.#])([\w-]+)")
_MEDIA = re.compile(r"\s*@media\b([^{]*)\Z", re.I)
_SCREEN = re.compile(r"(?:only\s+)?(?:screen|all)?", re.I)

Compound = tuple[str | None, str | None, frozenset[str]]  # type, id, classes


def declarations(text: str) -> list[tuple[str, str, bool]]:
    """``(property, value, important)`` of a declaration block."""
    return [(m[1].lower(), m[2].lower(), bool(m[3])) for m in _DECLARATION.finditer(text)]


def _selector(text: str):
    """``(compounds, combinators, specificity)`` from the last compound on; None
    if it holds what is left out."""
    steps = re.sub(r"\s*>\s*", " > ", text.strip()).split()
    compounds: list[Compound] = []
    combinators: list[str] = []
    weight = [0, 0, 0]
    for step in reversed(steps):
        if step == ">":
            if not compounds or len(combinators) >= len(compounds):
                return None
            combinators.append(">")
            continue
        m = _COMPOUND.fullmatch(step)
        if not m or not step:
            return None
        parts = _PART.findall(m[2])
        ids = {v for k, v in parts if k == "#"}
        if len(ids) > 1:
            return None
        if compounds and len(combinators) < len(compounds):
            combinators.append(" ")
        classes = frozenset(v for k, v in parts if k == ".")
        compounds.append((m[1].lower() if m[1] else None, next(iter(ids), None), classes))
        weight = [weight[0] + len(ids), weight[1] + len(classes), weight[2] + bool(m[1])]
    if not compounds or len(combinators) >= len(compounds):
        return None
    return compounds, combinators, tuple(weight)


def _blocks(sheet: str, top: bool = True):
    """``(prelude, body)`` of the rules that hold on a screen, in order."""
    at = 0
    while (brace := sheet.find("{", at)) >= 0:
        prelude = sheet[at:brace]
        prelude = prelude[prelude.rfind(";") + 1:] if "@media" not in prelude.lower() else prelude
        depth, end = 1, brace + 1
        for m in re.compile(r"[{}]").finditer(sheet, end):
            depth += 1 if m[0] == "{" else -1
            end = m.end()
            if not depth:
                break
        else:
            end = len(sheet) + 1
        body, at = sheet[brace + 1:end - 1], end
        media = _MEDIA.search(prelude)
        if media and top:
            if any(_SCREEN.fullmatch(x.strip()) for x in media[1].split(",")):
                yield from _blocks(body, False)
        elif not prelude.lstrip().startswith("@"):
            yield prelude, body


class Sheet:
    """The rules of a page's style elements.  Of rules with one selector only
    the last declaration of a property counts, so repeated rules are one."""

    def __init__(self, texts: list[str]):
        self.by: dict[tuple[str, str], dict] = {}  # key -> selector -> property -> (importance, weight, place), value
        place = 0
        for text in texts:
            for prelude, body in _blocks(_COMMENT.sub(" ", text)):
                found = declarations(body)
                for selector in prelude.split(",") if found else ():
                    parsed = _selector(selector)
                    if parsed is None:
                        continue
                    place += 1
                    compounds, combinators, weight = parsed
                    kind, ident, classes = compounds[0]
                    key = ("#", ident) if ident else (".", min(classes)) if classes else ("t", kind or "*")
                    said = self.by.setdefault(key, {}).setdefault((tuple(compounds), tuple(combinators)), {})
                    for name, value, important in found:
                        rank = (important, (0, *weight), place)
                        if name not in said or said[name][0] < rank:
                            said[name] = rank, value

    def __bool__(self) -> bool:
        return bool(self.by)

    def style(self, path: list) -> dict[str, str]:
        """``display`` and ``visibility`` that rules and the element's own
        style give it; ``path``: the element's ancestors and itself."""
        node = path[-1]
        classes = node.attrs.get("class", "").split()
        keys = [("t", node.tag), ("t", "*"), *((".", c) for c in set(classes))]
        if "id" in node.attrs:
            keys.append(("#", node.attrs["id"]))
        best: dict[str, tuple] = {}
        own = {name: ((important, (1, 0, 0, 0), i), value)
               for i, (name, value, important) in enumerate(sorted(declarations(node.attrs.get("style", "")),
                                                                   key=lambda d: d[2]))}
        rules = [said for key in keys for (compounds, combinators), said in self.by.get(key, {}).items()
                 if _matches(compounds, combinators, path)]
        for said in (*rules, own):
            for name, ranked in said.items():
                best[name] = max(best.get(name, ranked), ranked)
        return {name: value for name, (_, value) in best.items()}


def _holds(compound: Compound, node) -> bool:
    kind, ident, classes = compound
    return ((kind is None or kind == node.tag) and (ident is None or ident == node.attrs.get("id"))
            and (not classes or classes <= set(node.attrs.get("class", "").split())))


def _matches(compounds: tuple[Compound, ...], combinators: tuple[str, ...], path: list) -> bool:
    """Whether a selector holds for the last element of ``path``: all places in
    the path where each compound can stand, from the element upwards."""
    if not _holds(compounds[0], path[-1]):
        return False
    places = {len(path) - 1}
    for compound, how in zip(compounds[1:], combinators):
        top = max(places)
        candidates = {p - 1 for p in places if p} if how == ">" else range(top)
        places = {p for p in candidates if _holds(compound, path[p])}
        if not places:
            return False
    return True
