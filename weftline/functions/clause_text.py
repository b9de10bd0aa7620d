"""The rules that run along a clause's text: sentences, mentions, cues, and which cue takes which mention.

All offsets are code points, half-open. These are sequential folds over a text, so they run in Python over Arrow batches; whatever
can be said by column is in the operators that use them.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace
from functools import cache, lru_cache

from weftline.functions import rules
from weftline.functions.fixed import POINT_LETTERS
from weftline.functions.phrases import even_digits


def _phrase(words: str, **parts: str) -> str:
    """A pattern of a phrase: blanks match any white space, a comma may follow its word closely."""
    return r"\s+".join(parts.get(w.strip("{}"), re.escape(w)) for w in words.split()).replace(r"\s+,", r"\s*,")


def _any(words) -> str:
    return "(?:" + "|".join(_phrase(w) for w in sorted(words, key=len, reverse=True)) + ")"


TYPES = _any(rules.DOCUMENT_TYPES.values())
LEVELS = _any(rules.LEVEL_WORDS)
TYPE_KEYS = {re.sub(r"\s+", " ", v.lower()): k for k, v in rules.DOCUMENT_TYPES.items()}

NUMBER = r"\d{1,5}[A-Za-z]?(?:\s*[/-]\s*\d{4})?(?:\s*[/-]\s*[A-ZĐa-zđ]{1,10}\d{0,3})(?:-\s*[A-ZĐa-zđ0-9]{1,15})*"
DATE = r"ngày\s+\d{1,2}(?:\s*[/-]\s*\d{1,2}\s*[/-]\s*\d{4}|\s+tháng\s+\d{1,2}\s+năm\s+\d{4})"
VALUE = {"dieu": r"\d+[a-zđ]?", "khoan": r"\d+[a-zđ]?", "diem": r"[a-zđ](?:\.?\d+)?(?!\w)"}
SELF = r"này(?!\w)"
_SELF = re.compile(SELF, re.IGNORECASE)


@cache
def _components() -> re.Pattern:
    """A clause level with its values, or this one."""
    each = []
    for word, level in rules.LEVEL_WORDS.items():
        v = VALUE[level]
        each.append(rf"(?<!\w){word}\s+(?P<{level}>{SELF}|{v}(?:\s*(?:[,;]|(?:và|hoặc)(?!\w))\s*{v}(?!\w))*)")
    return re.compile("|".join(each), re.IGNORECASE)


@cache
def _documents() -> re.Pattern:
    title = r"[A-ZĐÀ-Ỹ]?[^,.;:()\n]*?(?=\s+(?:ngày|năm|số\s+\d|được|bị|và|hoặc|có\s+hiệu|hết\s+hiệu)\b|[,.;:()\n]|$)"
    return re.compile(
        rf"(?<!\w)(?P<type>{TYPES})(?!\w)(?:\s+(?P<self>{SELF})|(?:\s+(?:số\s*)?(?P<number>{NUMBER}))(?:\s+(?P<date>{DATE}))?|(?:\s+(?P<bare_date>{DATE}))|\s+(?P<title>{title})(?:\s+năm\s+(?P<year>\d{{4}}))?)",
        re.IGNORECASE,
    )


@dataclass(frozen=True)
class Mention:
    start: int
    stop: int
    point: str | None = None
    clause: str | None = None
    article: str | None = None
    doc_type: str | None = None
    number: str | None = None
    date: str | None = None
    title: str | None = None
    own: bool = False  # this document, or this article and the like
    #: Where in the text the point, clause, article, number, date and the title's type and words stand; none if the text does not have them.
    places: tuple = field(default=(None,) * 7, compare=False, repr=False)

    @property
    def key(self) -> str:
        """The clause key, child first; empty for a whole document."""
        return "_".join(f"{n}_{v}" for n, v in (("diem", self.point), ("khoan", self.clause), ("dieu", self.article)) if v)


@dataclass(frozen=True)
class Cue:
    start: int
    stop: int
    relation: str
    text: str
    backward: bool = False
    reason: str | None = None  # why it is rejected


def _embedded(text: str, at: int) -> bool:
    """A full stop inside a number or a letter-number token."""
    return text[at] == "." and 0 < at < len(text) - 1 and text[at + 1].isdigit() and (text[at - 1].isalnum())


def sentences(text: str) -> list[tuple[int, int]]:
    """Ranges between full stops, semicolons and line ends; blank ones are left out. Texts that differ in digits only have the same ones."""
    return _sentences(even_digits(text))


@lru_cache(maxsize=1024)
def _sentences(text: str) -> list[tuple[int, int]]:
    out, start = [], 0
    for at in [*(m.start() for m in re.finditer(r"[.;\n]", text)), len(text)]:
        if at < len(text) and _embedded(text, at):
            continue
        part = text[start:at]
        if part.strip():
            out.append((start + len(part) - len(part.lstrip()), start + len(part.rstrip())))
        start = at + 1
    return out


_BRACKETS = re.compile(r"\([^()]*\)")
_PROVENANCE = re.compile(_any(rules.PROVENANCE_WORDS), re.IGNORECASE)


@lru_cache(maxsize=8)
def masked(text: str) -> str:
    """The text with blanks in place of bracketed notes of history; as long as before."""
    if "(" not in text:
        return text
    return _BRACKETS.sub(lambda m: " " * len(m[0]) if _PROVENANCE.search(m[0]) else m[0], text)


_BETWEEN = re.compile(r"\s*(?:,|;|\bvà\b|\bhoặc\b)\s*")


def _value(said: str) -> str:
    return said.strip().lower().replace(".", "")


def value_places(listed: str) -> list[tuple[int, int]]:
    """Where the values of a list such as '3, 4 và 5' stand in it."""
    cuts = [(0, 0), *(m.span() for m in _BETWEEN.finditer(listed)), (len(listed),) * 2]
    return [(x[1], y[0]) for x, y in zip(cuts, cuts[1:], strict=False) if listed[x[1] : y[0]].strip()]


def values(listed: str) -> list[str]:
    """The values of a list such as '3, 4 và 5'."""
    return [_value(listed[i:j]) for i, j in value_places(listed)]


_RANGE = {
    "diem": re.compile(r"từ\s+điểm\s+([a-zđ])\s+đến\s+điểm\s+([a-zđ])(?!\w)", re.IGNORECASE),
    "khoan": re.compile(r"từ\s+khoản\s+(\d+)\s+đến\s+khoản\s+(\d+)(?!\w)", re.IGNORECASE),
}


def range_values(level: str, first: str, last: str) -> list[str]:
    """What lies from first to last: letters of points, or numbers; empty if out of order."""
    if level == "diem":
        letters = POINT_LETTERS.split()
        if first not in letters or last not in letters:
            return []
        return letters[letters.index(first) : letters.index(last) + 1]
    return [str(k) for k in range(int(first), int(last) + 1)]


@lru_cache(maxsize=1024)
def _level_places(part: str) -> tuple[list[tuple], list[tuple]]:
    """(start, stop, level, places of its values) of ranges, and of other components; no place for this one. Which digits there are does not matter."""
    ranges = [(*m.span(), level, m.span(1), m.span(2)) for level, pattern in _RANGE.items() for m in pattern.finditer(part)]
    found = []
    for m in _components().finditer(part):
        if not any(m.start() < r[1] and r[0] < m.end() for r in ranges):
            at, said = m.start(m.lastgroup), m[m.lastgroup]
            found.append((*m.span(), m.lastgroup, None if _SELF.fullmatch(said) else [(at + i, at + j) for i, j in value_places(said)]))
    return ranges, found


def _levels(text: str, a: int, b: int) -> list[tuple[int, int, str, list[tuple]]]:
    """(start, stop, level, values) of the clause components in text[a:b], in order; ranges count as one with all their values. With each value its
    place, if it stands in the text."""
    part = text[a:b]
    ranges, single = _level_places(even_digits(part))
    found = [(a + i, a + j, level, [(v, None) for v in range_values(level, part[slice(*x)].lower(), part[slice(*y)].lower())]) for i, j, level, x, y in ranges]
    found += [(a + i, a + j, level, [("này", None)] if x is None else [(_value(part[v:w]), (a + v, a + w)) for v, w in x]) for i, j, level, x in single]
    return sorted(found, key=lambda f: f[:3])


_ORDER = {"diem": 0, "khoan": 1, "dieu": 2}


def chains(parts: list[tuple[int, int, str, list[str]]]) -> list[dict]:
    """Components as chains of rising level, each with start, stop and values by level; lower ones inherit missing upper levels from the
    chain that follows."""
    out: list[dict] = []
    for start, stop, level, vals in parts:
        if not out or _ORDER[level] <= out[-1]["top"]:
            out.append({"start": start, "stop": stop, "top": _ORDER[level], level: vals})
        else:
            out[-1] |= {"stop": stop, "top": _ORDER[level], level: vals}
    above: dict[str, list[str]] = {}
    for c in reversed(out):
        lowest = min(_ORDER[n] for n in _ORDER if n in c)
        for n in ("khoan", "dieu"):
            if n in c:
                above[n] = c[n]
                if n == "dieu":
                    above.pop("khoan", None) if "khoan" not in c else None
            elif _ORDER[n] > lowest and n in above and not (n == "khoan" and "dieu" in c):
                c[n] = above[n]
    return out


_SUBORDINATE = re.compile(_any(rules.SUBORDINATE_PHRASES), re.IGNORECASE)


@lru_cache(maxsize=1024)
def _document_places(part: str) -> list[tuple]:
    """Start, stop and kind of the documents named, the places of number, date, and type and title, and whether it is this one. Which digits there are
    does not matter."""
    out: list[tuple] = []
    at = 0
    place = lambda m, *names: next((m.span(n) for n in names if m[n]), None)
    while m := _documents().search(part, at):
        kind = TYPE_KEYS[re.sub(r"\s+", " ", m["type"].lower())]
        if m["title"] is not None and (kind not in rules.TITLED_TYPES or not m["title"].strip()):
            at = m.end("type")  # what follows is no title, and may name a document itself
            continue
        at = m.end()
        if out and not out[-1][-1] and _SUBORDINATE.fullmatch(part[out[-1][1] : m.start()].strip(" ,").removesuffix(" một số điều của").removesuffix(" của").strip()):
            continue
        date = place(m, "date", "bare_date") or (place(m, "year") if m["title"] else None)
        title = place(m, "title")
        out.append((*m.span(), kind, place(m, "number"), date, m.span("type") if title else None, title, m["self"] is not None))
    return out


def _named(text: str, number: tuple | None, date: tuple | None, kind: tuple | None, title: tuple | None) -> tuple[str | None, str | None, str | None]:
    """Number, date and title of a document, by their places."""
    said = "".join(text[slice(*number)].split()) if number else None
    name = " ".join(f"{text[slice(*kind)]} {text[slice(*title)]}".split()) if title else None
    return said, text[slice(*date)] if date else None, name


def documents(text: str, a: int, b: int) -> list[Mention]:
    """Documents named in text[a:b]. One that only describes the one before it, after a subordinate phrase, is left out."""
    out: list[Mention] = []
    for start, stop, kind, *places, own in _document_places(even_digits(text[a:b])):
        places = [p and (a + p[0], a + p[1]) for p in places]
        out.append(Mention(a + start, a + stop, None, None, None, kind, *_named(text, *places), own, (None, None, None, *places)))
    return out


def _paired(chain: dict, docs: list[Mention]) -> Mention | None:
    """The document of a chain: the nearest; one before it is a last choice if one follows."""
    if not docs:
        return None
    after = any(d.start >= chain["stop"] for d in docs)
    return min(docs, key=lambda d: d.start - chain["stop"] if d.start >= chain["stop"] else chain["start"] - d.stop + 1000 * after)


def mentions(text: str, own_key: str = "") -> list[Mention]:
    """All references of a text, in order: every value of a list by itself. own_key is the key of the clause that the text is, for
    'this article' and the like."""
    return list(dict.fromkeys(_mentions(masked(text), own_key)))


def _mentions(plain: str, own_key: str) -> list[Mention]:
    """All references of a text whose history is masked, in order; a value that a list has twice is there twice."""
    own = dict(zip(own_key.split("_")[::2], own_key.split("_")[1::2], strict=False)) if own_key else {}
    none = [(None, None)]
    out: list[Mention] = []
    for a, b in sentences(plain):
        docs = documents(plain, a, b)
        linked = chains([p for p in _levels(plain, a, b) if not any(d.start <= p[0] < d.stop for d in docs)])
        used = set()
        for c in linked:
            d = _paired(c, docs)
            if d:
                used.add(d)
            own_level = any(v == "này" for n in _ORDER if n in c for v, _ in c[n])
            whole = Mention(c["start"], c["stop"], own=own_level or (d is not None and d.own))
            if d:
                start, stop = min(c["start"], d.start), max(c["stop"], d.stop)
                whole = replace(whole, doc_type=d.doc_type, number=d.number, date=d.date, title=d.title, start=start, stop=stop, places=d.places)
            for article, article_at in c.get("dieu", none):
                for clause, clause_at in c.get("khoan", none):
                    for point, point_at in c.get("diem", none):
                        here = {"point": point, "clause": clause, "article": article}
                        for name, level in (("point", "diem"), ("clause", "khoan"), ("article", "dieu")):
                            if here[name] == "này":
                                here[name] = own.get(level)
                        if own_level:  # what is above 'this one' is this clause's
                            top = max(_ORDER[n] for n in _ORDER if n in c)
                            for name, level in (("clause", "khoan"), ("article", "dieu")):
                                if here[name] is None and _ORDER[level] > top:
                                    here[name] = own.get(level)
                        places = (point_at, clause_at, article_at, *whole.places[3:])
                        out.append(Mention(whole.start, whole.stop, here["point"], here["clause"], here["article"], whole.doc_type, whole.number, whole.date, whole.title, whole.own, places))
        out += [d for d in docs if d not in used]
    return sorted(out, key=lambda m: (m.start, m.stop))


@cache
def _cue_pattern() -> tuple[re.Pattern, list[tuple[str, bool]]]:
    """One pattern that looks at each place for the longest phrase there, with the relation and side of each of its groups."""
    parts = {"type": f"(?:{TYPES}|{LEVELS})", "doc": TYPES}
    every = [(p, rel, False) for rel, phrases in rules.CUE_PHRASES.items() for p in phrases]
    every += [(p, rel, True) for rel, phrases in rules.PASSIVE_PHRASES.items() for p in phrases]
    every += [(p, "thay_the", True) for p in rules.EXPIRY_REPLACED] + [(p, "bai_bo", True) for p in rules.EXPIRY_REPEALED]
    every.sort(key=lambda x: -len(x[0]))
    # A last word "từ" is the noun, not the "from" of a range of clauses.
    noun = rf"(?!\s+{LEVELS})"
    body = "|".join(f"(?P<g{k}>{_phrase(p, **parts)}){noun if p.endswith(' từ') else ''}" for k, (p, _, _) in enumerate(every))
    first = "|".join(sorted({p.split()[0] for p, _, _ in every}))  # few places start with one of these words
    return re.compile(rf"(?<!\w)(?={first})(?=(?:{body})(?!\w))", re.IGNORECASE), [(rel, back) for _, rel, back in every]


_TYPE_TAIL = re.compile(rf"(?:{TYPES}|{LEVELS})$", re.IGNORECASE)


@cache
def _distractors() -> list[tuple[str, re.Pattern, re.Pattern]]:
    return [(reason, re.compile(r"^" + _any(actions), re.I), re.compile(r"(?<!\w)" + _any(objects), re.I)) for reason, actions, objects in rules.DISTRACTORS]


def longest_first(spans: list) -> list:
    """Of spans with start and stop those left if the longest is taken first and what overlaps it is dropped, in order."""
    out: list = []
    for s in sorted(spans, key=lambda s: (s.start - s.stop, s.start)):
        if not any(s.start < t.stop and t.start < s.stop for t in out):
            out.append(s)
    return sorted(out, key=lambda s: s.start)


def cues(text: str) -> list[Cue]:
    """Actions named in a text, without overlaps; those that a look-ahead rejects carry a reason. No phrase of an action has a digit, and which
    digits a sentence has does not matter, so texts that differ in digits only have the same ones."""
    return list(_cues(even_digits(masked(text))))


@lru_cache(maxsize=1024)
def _cues(plain: str) -> tuple[Cue, ...]:
    pattern, kinds = _cue_pattern()
    found = []
    for m in pattern.finditer(plain):
        said = m[m.lastgroup]
        relation, backward = kinds[int(m.lastgroup[1:])]
        stop = m.start() + len(said)
        if relation == "dan_chieu" and (tail := _TYPE_TAIL.search(said)):
            stop = m.start() + tail.start()  # the type word belongs to the mention
        found.append(Cue(m.start(), stop, relation, plain[m.start() : stop].strip(), backward))
    out = []
    for c in longest_first(found):
        ahead = plain[c.stop : c.stop + rules.LOOK_AHEAD]
        reason = next((r for r, action, objects in _distractors() if action.search(c.text) and objects.search(ahead)), None)
        if c.backward and c.relation == "sua_doi_bo_sung" and ":" not in plain[c.stop : _sentence_of(plain, sentences(plain), c.start)[1] + 1]:
            reason = "passive_without_colon"
        out.append(replace(c, reason=reason) if reason else c)
    return tuple(out)


def _sentence_of(text: str, scopes: list[tuple[int, int]], at: int) -> tuple[int, int]:
    return next(((a, b) for a, b in scopes if a <= at <= b), (0, len(text)))


def matches(text: str, own_key: str = "") -> list[tuple[Cue, Mention]]:
    """Each cue with the mentions it acts on: forward ones those up to the next cue in the sentence, and if there are none up to its end, or a list
    below; backward ones those before it in the sentence. Then the filters, and the relation by the target's scope.

    Texts that differ in digits only are judged once; for the others what their digits say is read at the places that were found."""
    plain = masked(text)
    shape = even_digits(plain)
    plan = _plan(shape, own_key if own_key and _says_this(shape) else "")
    if plan is not None:
        lists, pairs = plan
        if all(len({_value(plain[i:j]) for i, j in at}) == len(at) for at in lists):
            return [(c, _read(plain, m)) for c, m in pairs]
    return _judged(plain, _reached(plain, list(dict.fromkeys(_mentions(plain, own_key)))))


@lru_cache(maxsize=1024)
def _says_this(shape: str) -> bool:
    return _SELF.search(shape) is not None


def _read(plain: str, m: Mention) -> Mention:
    """A mention of a text that differs in digits only, with what this text says."""
    x, y, z, number, date, kind, title = m.places
    point = _value(plain[x[0] : x[1]]) if x else m.point
    clause = _value(plain[y[0] : y[1]]) if y else m.clause
    article = _value(plain[z[0] : z[1]]) if z else m.article
    return Mention(m.start, m.stop, point, clause, article, m.doc_type, *_named(plain, number, date, kind, title), m.own, m.places)


@lru_cache(maxsize=1024)
def _plan(shape: str, own_key: str) -> tuple[list[list[tuple]], list[tuple[Cue, Mention]]] | None:
    """What matches() finds in every text that differs from this one, whose history is masked, in digits only: the places of lists, whose values must
    differ in each, and cues with mentions. None if it depends on the digits: with ranges, and where filters compare numbers."""
    from weftline.functions.match_filters import by_number

    lists = []
    for a, b in sentences(shape):
        ranges, single = _level_places(shape[a:b])
        if ranges:
            return None
        lists += [[(a + i, a + j) for i, j in x] for *_, x in single if x and len(x) > 1]
    reached = _reached(shape, _mentions(shape, own_key))
    if any(by_number(c, got) for c, got in reached):
        return None
    return lists, _judged(shape, reached)


def _reached(plain: str, refs: list[Mention]) -> list[tuple[Cue, list[Mention]]]:
    """The cues of a text whose history is masked, with the mentions that each reaches."""
    if not refs:
        return []
    from weftline.functions import targets

    acts = [c for c in _cues(even_digits(plain)) if c.reason is None and not targets.needless(plain, c, refs)]
    acts = sorted(targets.goes_on(plain, acts, refs), key=lambda c: c.start)
    scopes, out = sentences(plain), []
    for k, c in enumerate(acts):
        a, b = _sentence_of(plain, scopes, c.start)
        if c.backward:
            got = [m for m in refs if a <= m.start and m.stop <= c.start]
        else:
            fence = min([b, *(d.start for d in acts[k + 1 : k + 2] if d.start < b)])
            got = [m for m in refs if c.stop <= m.start < fence] or [m for m in refs if c.stop <= m.start < b]
            got = targets.inserted(plain, c, targets.listed(plain, c, targets.in_same_brackets(plain, c, got), refs, acts))
        out.append((c, got))
    return out


def _judged(plain: str, reached: list[tuple[Cue, list[Mention]]]) -> list[tuple[Cue, Mention]]:
    """What the filters leave of the mentions that cues reach, with the relation by the target's scope."""
    from weftline.functions.match_filters import filtered, refined

    out = []
    for c, got in reached:
        for m in filtered(plain, c, got):
            relation = refined(plain, c, m)
            out.append((c if relation == c.relation else replace(c, relation=relation), m))
    return out
