"""Which mentions an action reaches beyond its sentence, or not: lists under a heading, labels that are inserted, brackets, and actions that are none.

Each rule takes the text with history masked, the cue and mentions, and gives the mentions that it takes."""

from __future__ import annotations

import re
from dataclasses import replace

from weftline.functions.clause_text import TYPE_KEYS, Cue, Mention
from weftline.functions.phrases import Words, phrase, phrases, words_of

# --- fixed values ---

#: Actions whose targets may be a list of items under a heading.
LISTED_ACTIONS = ("bai_bo", "huy_bo", "thay_the", "dinh_chi", "ngung_hieu_luc", "keo_dai_hieu_luc")
GUIDANCE = ("quy_dinh_chi_tiet", "huong_dan")
INSERTED_AT = phrases(("vào sau", "vào trước", "vào cuối"))
GOES_ON = phrases(("tiếp tục thực hiện", "tiếp tục áp dụng", "tiếp tục được áp dụng", "tiếp tục được thực hiện", "tiếp tục thi hành"))

# --- end of fixed values ---

_TYPES = tuple(sorted(map(phrase, TYPE_KEYS), key=len, reverse=True))
#: Signs that may stand between a mention and an action that describes it.
_CLOSE = 80


def is_item(line: str) -> bool:
    """Whether a line starts as an item of a list: with a dash or bullet, or with a letter or number and a bracket or full stop."""
    w = Words(line[:16])
    k = 1 if w[0] == "(" else 0
    return w[0] in ("-", "–", "•", "+", "*") or ((len(w[k]) == 1 and w[k].isalpha()) or w[k].isdigit()) and w[k + 1] in (")", ".")


def list_start(text: str, after: int) -> int | None:
    """Where the first line behind an offset starts that is an item of a list."""
    at = text.find("\n", after)
    while at >= 0:
        end = text.find("\n", at + 1)
        if is_item(text[at + 1 : end if end >= 0 else len(text)]):
            return at + 1
        at = end
    return None


def brackets(text: str) -> list[tuple[int, int]]:
    """Places of balanced brackets, inner ones before outer ones."""
    out, held = [], []
    for m in re.finditer("[()]", text):
        if m[0] == "(":
            held.append(m.start())
        elif held:
            out.append((held.pop(), m.start()))
    return out


def in_same_brackets(text: str, cue: Cue, got: list[Mention]) -> list[Mention]:
    """What an action in brackets acts on stands in the same ones."""
    around = next(((a, b) for a, b in brackets(text) if a < cue.start < b), None)
    return [m for m in got if around[0] < m.start and m.stop <= around[1]] if around else got


def listed(text: str, cue: Cue, got: list[Mention], refs: list[Mention], acts: list[Cue]) -> list[Mention]:
    """The items of a list after an action's heading, instead of the documents that the heading says besides (a heading that says none takes nothing);
    not if the items have actions of their own. Items of a guided document's list are clauses of that document."""
    if cue.relation not in (*LISTED_ACTIONS, *GUIDANCE) or not got:
        return got
    start = list_start(text, cue.stop)
    if start is None or any(c.start >= start and c.relation != "dan_chieu" for c in acts):
        return got
    items = [m for m in refs if m.start >= start]
    if cue.relation in GUIDANCE:
        document = next((m for m in got if m.doc_type and not m.own), None)
        if document is None or ":" not in text[cue.stop : start]:
            return got
        named = {"doc_type": document.doc_type, "number": document.number, "date": document.date, "title": document.title}
        items = [m if m.doc_type else replace(m, **named, places=m.places[:3] + document.places[3:]) for m in items if m.key]
    return items or got


def inserted(text: str, cue: Cue, got: list[Mention]) -> list[Mention]:
    """Labels that are inserted, not the clause that they are put after or before."""
    if cue.relation != "sua_doi_bo_sung" or len(got) < 2:
        return got
    words = words_of(text)
    place = words.first(words.at(cue.stop), words.at(got[-1].stop), INSERTED_AT)
    return [m for m in got if m.start < words.starts[place[0]]] or got if place else got


def goes_on(text: str, acts: list[Cue], refs: list[Mention]) -> list[Cue]:
    """A document that is applied further is only cited: in such a sentence that action takes the place of all others."""
    words = words_of(text)
    place = words.first(0, len(words.words), GOES_ON)
    if place is None:
        return acts
    start, stop = words.starts[place[0]], words.stops[place[1] - 1]
    end = min((k for k in (text.find(s, stop) for s in ".\n") if k >= 0), default=len(text))
    if not any(start <= m.start < end for m in refs):
        return acts
    return [*(c for c in acts if not start <= c.start < end), Cue(start, stop, "dan_chieu", text[start:stop])]


def needless(text: str, cue: Cue, refs: list[Mention]) -> bool:
    """An action's words that are part of a document's name: right behind a type word, right before a line's end, or close behind a document in the
    same part of a sentence. Passive ones, and those in an enumeration, are meant."""
    if cue.backward or cue.relation == "dan_chieu":
        return False
    words = words_of(text)
    k = words.at(cue.start)
    if words.ends_with(k, _TYPES):
        return True
    return any(0 <= cue.start - m.stop <= _CLOSE and m.number and not re.search(r"[.;:,()\n]|\bvà\b", text[m.stop : cue.start]) and any(cue.stop <= n.start for n in refs) for m in refs if m.doc_type and not m.own)


