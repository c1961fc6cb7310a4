"""Personal data in whole texts, found as it stands and behind disguises, with spans in the source."""

from __future__ import annotations

import hashlib
import re
import unicodedata
from array import array
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from heapq import merge
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasheaf.llm.common import texts_of

KINDS = ["email", "ip", "card", "phone"]

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)+")
DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def plain_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of local part, @ and dotted domain, found from each @ so that time stays linear."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            free = m.end()
            out.append((start, free, "email"))
        at = text.find("@", max(at + 1, free))
    return out


def addresses(text: str) -> list[Span]:
    """Four dotted numbers; a longer chain gives one match for every four of its parts, as leftmost matching does."""
    out = []
    for m in DOTTED.finditer(text):
        start, parts = m.start(), m[0].split(".")
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                out.append((start, end, "ip"))
            start = end + 1
    return out


def cards(text: str) -> list[Span]:
    return [(m.start(), m.end(), "card") for m in DIGITS.finditer(text) if m.end() - m.start() >= 14 and 14 <= len(d := plain_digits(m[0])) <= 19 and luhn(d)]


def phones(text: str) -> list[Span]:
    return [(m.start(), m.end(), "phone") for m in PHONE.finditer(text) if 10 <= len(plain_digits(m[0])) <= 15]


def identifiers(text: str) -> list[Span]:
    """What the base rules find, each kind for itself."""
    out = emails(text) if "@" in text else []
    if "." in text:
        out += addresses(text)
    return out + cards(text) + (phones(text) if "+" in text else [])


# Letters of other scripts that look like Latin ones, as pairs of look-alike and Latin letter.
LOOKALIKES = dict(zip("аесорхуѕіјԁһԛԝАВЕКМНОРСТХУІЈЅοαερυινκτχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aecopxysijdhqwABEKMHOPCTXYIJSoaepuivktxABEZHIKMNOPTYX", strict=True))
# Characters that look like punctuation of identifiers.
MARKS = {"＠": "@", "﹫": "@", "．": ".", "。": ".", "․": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "﹣": "-", "－": "-", "＋": "+", "﹢": "+", "＿": "_", " ": " ", " ": " ", " ": " ", " ": " ", "　": " "}
# Invisible characters that may stand inside an identifier.
INVISIBLE = frozenset("​‌‍⁠﻿­")
# The names of the digits from 0 to 9 in four languages, and others in use.
DIGIT_NAMES = [
    "zero one two three four five six seven eight nine",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
]
SPELLED = {name: str(d) for names in DIGIT_NAMES for d, name in enumerate(names.split())} | {"oh": "0", "fuenf": "5", "zwo": "2"}

# One transducer: a run of spelled digits becomes digits. Separators between them are single spaces, hyphens, commas, dots or slashes.
NAMES = "|".join(sorted(SPELLED, key=len, reverse=True))
DIGIT_WORD = re.compile(rf"(?<![^\W_])(?:{NAMES})(?![^\W_])", re.IGNORECASE)
# How markup and addresses spell the two signs.
ENTITY_AT, ENTITY_DOT = r"&#0*64;|&#x0*40;|&commat;|%40", r"&#0*46;|&#x0*2e;|&period;|%2e"
# Another: bracketed at and dot signs in any case, with the spaces around them, and bare words where both occur together.
AT = r"(?:(?<![ ])[ ]++)?+[\[({<][ ]*+(?:at|@|arroba|arobase)[ ]*+[\])}>][ ]*+"
DOT = r"(?:(?<![ ])[ ]++)?+[\[({<][ ]*+(?:dot|\.|punkt|punto|point)[ ]*+[\])}>][ ]*+"
BRACKETED = re.compile(rf"(?P<at>{AT})|(?P<dot>{DOT})", re.IGNORECASE)
ENTITIES = re.compile(rf"(?P<at>{ENTITY_AT})|(?P<dot>{ENTITY_DOT})", re.IGNORECASE)
WORD_AT, WORD_DOT = r"(?:[ ]+(?:at|arroba|arobase)[ ]+|[-_](?:at|arroba|arobase)[-_])", r"(?:[ ]+(?:dot|punkt|punto|point)[ ]+|[-_](?:dot|punkt|punto|point)[-_])"
# Signs as they stand after the folding of entities and brackets: each at and each dot is literal, spaced or spelled, whatever the others are.
AT_SIGN = re.compile(rf"(?<=[A-Za-z0-9._%+-])(?:(?P<spelled>{WORD_AT})|(?P<literal>[ ]*+@[ ]*+))(?=[A-Za-z0-9-])", re.IGNORECASE)
DOT_SIGN = re.compile(rf"(?:(?P<spelled>{WORD_DOT})|\.|[ ]\.[ ])(?=[A-Za-z0-9-])", re.IGNORECASE)
LABEL = re.compile(r"(?:[A-Za-z0-9]|-(?!(?:dot|punkt|punto|point)[-_]))+", re.IGNORECASE)
PATH = re.compile(r"/|[:?#]\S")
LOCAL_DOT = re.compile(rf"(?<=[A-Za-z0-9%+]){WORD_DOT}\Z", re.IGNORECASE)
# The top-level domains that make a mixed disguise an address, country codes and the usual generic ones.
TOP_LEVEL = frozenset(
    "ac ad ae af ag ai al am ao aq ar as at au aw ax az ba bb bd be bf bg bh bi bj bm bn bo br bs bt bw by bz ca cc cd cf cg ch ci ck cl cm cn co cr cu cv cw cx cy cz "
    "de dj dk dm do dz ec ee eg er es et eu fi fj fk fm fo fr ga gb gd ge gf gg gh gi gl gm gn gp gq gr gs gt gu gw gy hk hm hn hr ht hu id ie il im in io iq ir is it "
    "je jm jo jp ke kg kh ki km kn kp kr kw ky kz la lb lc li lk lr ls lt lu lv ly ma mc md me mg mh mk ml mm mn mo mp mq mr ms mt mu mv mw mx my mz na nc ne nf ng ni "
    "nl no np nr nu nz om pa pe pf pg ph pk pl pm pn pr ps pt pw py qa re ro rs ru rw sa sb sc sd se sg sh si sk sl sm sn so sr ss st su sv sx sy sz tc td tf tg th tj "
    "tk tl tm tn to tr tt tv tw tz ua ug uk us uy uz va vc ve vg vi vn vu wf ws ye yt za zm zw aero app arpa asia bank biz blog cat cloud club com coop dev edu email "
    "example gmail gov gob info int internal jobs live local mail mil mobi museum name net news online org post pro shop site space store studio tech tel today top travel "
    "web website wiki work world xyz zone".split()
)
# Words that stand before 'at' and a site's name in prose, where nothing else is disguised.
BEFORE_SITE = frozenset(
    "a about all also am and any are arrive arrived as available be been buy call check click code come contact data details do docs documentation download downloaded downloads find first "
    "follow for found free friends go got guys have her here him home hosted i info information is it join just keep latest live located look looked looking looks made me meet met more "
    "news not now of on online only or order out page people posted project published read register see seen sell shop sign site so sold source stay store team that the them there "
    "these this those up updates us version visit was watch we website were work worked working works written you".split()
)
# Those that stand before a site's name even where its dots are spelled too.
LOOKING = frozenset("are available be check find found go hosted is live located look looked looking looks read register see seen sign visit was watch were".split())
LONGEST_BEFORE_SITE = max(map(len, BEFORE_SITE))
NUMBER_DOT = re.compile(r"(?<=[0-9])[ ]+(?:dot|punkt|punto|point)[ ]+(?=[0-9])", re.IGNORECASE)
SPELLED_SIGN = re.compile(r"[ ]*(?<![^\W_])(?P<sign>plus|dot|point|punto|punkt|dash|hyphen)(?![^\W_])[ ]*", re.IGNORECASE)
SIGNS = {"plus": "+", "dot": ".", "point": ".", "punto": ".", "punkt": ".", "dash": "-", "hyphen": "-"}


class Rewritten:
    """A text after some rewriting, with the source span of each of its characters: edits are kept, and spans found among them by bisection.

    One character that takes the place of another moves nothing and costs nothing; other edits are four numbers each."""

    def __init__(self, text: str, before: Rewritten | None = None, edits: tuple[array, ...] = ()):
        self.text, self.before, self.edits = text, before, edits

    def replace(self, edits: Iterable[tuple[int, int, str]]) -> Rewritten:
        """Each (start, end, new) edit of this text, in order; a new character covers the source of all it replaces."""
        text, last, size = [], 0, 0
        places, ends, lows, highs = array("q"), array("q"), array("q"), array("q")
        for start, end, new in edits:
            text += [self.text[last:start], new] if last < start else [new]
            size += start - last
            if end - start != 1 or len(new) != 1:
                places.append(size)
                ends.append(size + len(new))
                lows.append(start)
                highs.append(end)
            size += len(new)
            last = end
        if not text:
            return self
        return Rewritten("".join([*text, self.text[last:]]), self, (places, ends, lows, highs))

    def earlier(self, at: int) -> tuple[int, int]:
        """The span of the text before this rewriting that the character at ``at`` comes from."""
        places, ends, lows, highs = self.edits
        k = bisect_right(places, at) - 1
        if k < 0:
            return at, at + 1
        if at < ends[k]:
            return lows[k], highs[k]
        return highs[k] + at - ends[k], highs[k] + at - ends[k] + 1

    def source(self, start: int, end: int) -> tuple[int, int]:
        step = self
        while step.before is not None:
            start, end = step.earlier(start)[0], step.earlier(end - 1)[1]
            step = step.before
        return start, end


# Spaces of other widths.
WIDE_SPACES = "    　"
WORD = re.compile(rf"\S+|[{WIDE_SPACES}]")


def character_edits(text: str) -> Iterator[tuple[int, int, str]]:
    for m in WORD.finditer(text):
        word = m[0]
        if word.isascii():
            continue
        if word in WIDE_SPACES:
            yield m.start(), m.end(), " "
            continue
        mixed = any(c.isascii() and (c.isalnum() or c in "@.+") for c in word) or any(c in MARKS or unicodedata.normalize("NFKC", c).isascii() for c in word)
        for k, c in enumerate(word, m.start()):
            if c.isascii():
                continue
            if c in INVISIBLE:
                yield k, k + 1, ""
            elif c in MARKS:
                yield k, k + 1, MARKS[c]
            elif c.isdecimal():
                yield k, k + 1, str(unicodedata.decimal(c))
            elif mixed and c in LOOKALIKES:
                yield k, k + 1, LOOKALIKES[c]
            elif mixed and len(same := unicodedata.normalize("NFKC", c)) == 1 and same.isascii():
                yield k, k + 1, same


def fold_characters(text: Rewritten) -> Rewritten:
    """Look-alike letters, wide and other digits, look-alike punctuation and invisible characters.

    A look-alike letter is folded only in a word that has Latin letters, digits or signs of an identifier as well, so that plain Cyrillic or
    Greek text stays what it is."""
    return text.replace(character_edits(text.text))


def plausible(label: str) -> bool:
    """Whether a name may end in this label. A capital alone begins a sentence."""
    return (label.islower() or label.isupper()) and (label.lower() in TOP_LEVEL or label.lower().startswith("xn--"))


def domain_signs(text: str, end: int, spelled: bool, alike: bool) -> tuple[list[re.Match], int]:
    """The dots of a domain name whose first label ends at ``end``, and where the name ends: at its last label if all dots are disguised as
    the at sign is (``alike``: and that is neither a bare @ nor a word between spaces), else at its last plausible top-level domain."""
    dots, n, stop = [], 0, end
    while dot := DOT_SIGN.match(text, end):
        label = LABEL.match(text, dot.end())
        if not label:
            break
        dots.append(dot)
        end = label.end()
        alike = alike and (dot["spelled"] is not None) == spelled
        if alike or plausible(label[0]):
            n, stop = len(dots), end
    return dots[:n], stop


def address_signs(text: str) -> list[tuple[int, int, str]]:
    """Edits that make signs of what stands for them in addresses, found from each at sign.

    An at and dots that all stand between hyphens, or a spaced @ before literal or spaced dots, are signs before any label; words between
    spaces and mixtures only up to the last plausible top-level domain. A spelled at isn't a sign after a word that sends readers to a site,
    nor, with no other disguise, after other words of prose or in paths.
    What several at signs in a row have in common, the run of characters before and the name after them, is looked at once: linear time."""
    edits: list[tuple[int, int, str]] = []
    free = run_start = label_start = 0
    run_end = label_end = -1
    names: dict[tuple[bool, bool], tuple[list[re.Match], int]] = {}
    for m in AT_SIGN.finditer(text):
        if m.start() < free:
            continue
        start = m.start()
        while start > free and text[start - 1] in LOCAL:
            start -= 1
            if start == run_end:
                start = max(run_start, free)
                break
        run_start, run_end = start, m.start()
        if not label_start <= m.end() < label_end:
            label = LABEL.match(text, m.end())
            label_start, label_end, names = m.end(), label.end() if label else -1, {}
        if start == m.start() or label_end < 0:
            continue
        spelled = m["spelled"] is not None
        sort = spelled, m[0] != "@" and not (spelled and m[0][0] == " ")
        if sort not in names:
            names[sort] = domain_signs(text, label_end, *sort)
        dots, stop = names[sort]
        if not dots:
            continue
        if spelled:
            bare = all(d[0] == "." for d in dots)
            before = text[start : m.start()].lower() if m.start() - start <= LONGEST_BEFORE_SITE else ""
            if before in (BEFORE_SITE if bare else LOOKING if m[0][0] == " " else ()) or bare and (text[start - 1 : start] == "/" or PATH.match(text, stop)):
                continue
        while before := LOCAL_DOT.search(text, max(free, start - 16), start):
            edits.append((before.start(), start, "."))
            start = before.start()
            while start > free and text[start - 1] in LOCAL:
                start -= 1
        edits.append((m.start(), m.end(), "@"))
        edits += [(d.start(), d.end(), ".") for d in dots]
        free, names = stop, {}
    return sorted((a, b, new) for a, b, new in edits if text[a:b] != new)


def sign_edits(pattern: re.Pattern, text: str) -> Iterator[tuple[int, int, str]]:
    return ((m.start(), m.end(), "@" if m.groupdict().get("at") else ".") for m in pattern.finditer(text))


def fold_signs(text: Rewritten) -> Rewritten:
    """Disguised at and dot signs: entities and bracketed ones by themselves, bare words only between numbers or as part of a whole address,
    in which each sign may be disguised in its own way."""
    for pattern in (ENTITIES, NUMBER_DOT, BRACKETED):
        text = text.replace(sign_edits(pattern, text.text))
    return text.replace(address_signs(text.text))


#: Runs of digits and of letters that stand for digits, as long as the shortest identifier of digits, and what the letters stand for. Up to
#: two characters may separate them, as in (555) 123.
DIGIT_LIKE = re.compile(r"[0-9OolI](?:[ .()-]{0,2}[0-9OolI]){6,}")
LIKE = {"O": "0", "o": "0", "l": "1", "I": "1"}


def letter_edits(text: str) -> Iterator[tuple[int, int, str]]:
    for m in DIGIT_LIKE.finditer(text):
        letters = sum(c in LIKE for c in m[0])
        digits = sum("0" <= c <= "9" for c in m[0])
        if letters and digits >= 2 * letters:
            yield from ((k, k + 1, LIKE[c]) for k, c in enumerate(m[0], m.start()) if c in LIKE)


def fold_digit_letters(text: Rewritten) -> Rewritten:
    """Letters that look like digits, in runs of which two thirds at least are digits: in fewer, words such as 'Ill' would be numbers."""
    return text.replace(letter_edits(text.text))


NUMERAL = re.compile(r"[0-9]+")
PLUS = re.compile(r"(?:\+|(?<![^\W_])plus)[ ]?\Z", re.IGNORECASE)
SEPARATOR = re.compile(r"[ ,/-]{0,3}|[ ]?[.()][ ]?")


def digit_edits(text: str) -> Iterator[tuple[int, int, str]]:
    """Edits of each group of digits' names and numerals that signs or separators join."""
    starts, ends, news = array("q"), array("q"), []
    items = names = 0
    prose = False

    def edit(start: int, end: int, new: str) -> None:
        starts.append(start)
        ends.append(end)
        news.append(new)

    last = None
    both = merge(((m.start(), m.end(), True) for m in DIGIT_WORD.finditer(text)), ((m.start(), m.end(), False) for m in NUMERAL.finditer(text)))
    for start, end, named in chain(both, [(len(text) + 1, len(text) + 1, False)]):
        between = text[last:start] if last is not None and start <= len(text) else None
        sign = SPELLED_SIGN.fullmatch(between) if between else None
        joins = sign or between is not None and SEPARATOR.fullmatch(between)
        new = None
        if joins and between:
            stripped = between.strip()
            new = SIGNS[sign["sign"].lower()] if sign else stripped if stripped in (".", "-", "(", ")") else ""
            edit(last, start, new)
        elif not joins:
            if items >= 4 and not prose:
                yield from zip(starts, ends, news, strict=True)
            starts, ends, news, items, names = array("q"), array("q"), [], 0, 0
            if plus := PLUS.search(text, max(0, start - 8), min(start, len(text))):
                edit(plus.start(), start, "+")
        prose = named and names == 0 and items > 0 and new == ""  # such as 'un' after a number
        items += 1
        names += named
        if named:
            edit(start, end, SPELLED[text[start:end].lower()])
        last = end


def fold_digits(text: Rewritten) -> Rewritten:
    """Spelled digits next to each other: their names become digits, signs between them become signs, and what separates them goes. Fewer
    than four digits are no identifier, and a lone name at the end of a number is a word of the text."""
    return text.replace(digit_edits(text.text))


#: Characters that may be part of a disguise; other non-ASCII letters, such as accented ones, are not worth a second look.
ODD = re.compile("[" + re.escape("".join([*LOOKALIKES, *MARKS, *INVISIBLE])) + "！-～٠-٩۰-۹०-९\U0001d400-\U0001d7ff\u2100-\u214f]")
DISGUISES = re.compile(
    rf"{ENTITY_AT}|{ENTITY_DOT}|[ ]@|@[ ]|@[A-Za-z0-9.-]+[ ]\.[ ]|[-_ ](?:dot|punkt|punto|point)[-_ ]"
    r"|[-_ ](?:at|arroba|arobase)[-_ ]++(?:(?![-_](?:at|arroba|arobase)[-_])[A-Za-z0-9-])++(?:\.|[ ]\.[ ])[A-Za-z0-9-]"
    r"|[\[({<][ ]*+(?:at|@|arroba|arobase|dot|\.|punkt|punto|point)[ ]*+[\])}>]",
    re.IGNORECASE,
)
LETTER_DIGITS = re.compile(r"[0-9][ .()-]?[OolI](?![A-HJ-NP-Za-km-np-z])|(?<![A-Za-z])[OolI][ .()-]?[0-9]")
# A digit's name next to another, a numeral or a spelled sign, with the separators of fold_digits: each group that it folds has one such pair.
BETWEEN = r"(?:[ ,/-]{1,3}|[ ]?[.()][ ]?|[ ]++(?:plus|dot|point|punto|punkt|dash|hyphen)[ ]++)"
NAME_FIRST = re.compile(rf"(?<![^\W_])(?:{NAMES}){BETWEEN}(?:[0-9]|(?:{NAMES})(?![^\W_]))", re.IGNORECASE)
NUMERAL_FIRST = re.compile(rf"[0-9]{BETWEEN}(?:{NAMES})(?![^\W_])", re.IGNORECASE)


def spelled_digits(text: str) -> bool:
    return bool(NAME_FIRST.search(text) or NUMERAL_FIRST.search(text))


def disguised(text: str) -> list[Span]:
    """Identifiers that show after normalisation, as spans of the source.

    The transducers run one after the other, and each keeps the source span of every character it writes. Long texts are normalised whole.
    """
    odd, signs, digits, letters = ODD.search(text), DISGUISES.search(text), spelled_digits(text), LETTER_DIGITS.search(text)
    if not (odd or signs or digits or letters):
        return []
    folded = Rewritten(text)
    if odd:
        folded = fold_characters(folded)
        signs, digits, letters = DISGUISES.search(folded.text), spelled_digits(folded.text), LETTER_DIGITS.search(folded.text)
    versions = [folded]
    if digits:
        versions.append(fold_digits(folded))
    if letters:
        versions.append(fold_digit_letters(versions[-1]))
    if signs:
        versions.append(fold_signs(versions[-1]))
    out: dict[tuple[int, int, str], None] = {}
    for version in versions:
        if version.text != text:
            for start, end, kind in identifiers(version.text):
                out[(*version.source(start, end), kind)] = None
    return list(out)


def all_spans(text: str) -> tuple[list[Span], list[Span]]:
    """The base spans, and those with what the method adds: disguised identifiers that lie in no base span of their kind and overlap none
    of each other."""
    base = sorted(identifiers(text), key=lambda s: (s[0], KINDS.index(s[2])))
    added: list[Span] = []
    more = disguised(text)
    known = {k: [(s, e) for s, e, kind in base if kind == k] for k in KINDS} if more else {}
    taken: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    for start, end, kind in sorted(more, key=lambda s: (s[0] - s[1], s[0])):
        before = bisect_right(known[kind], (start, 1 << 62)) - 1
        within = before >= 0 and end <= known[kind][before][1]
        place = bisect_right(taken[kind], (start, end))
        if not within and all(e <= start or end <= s for s, e in taken[kind][max(0, place - 1) : place + 1]):
            taken[kind].insert(place, (start, end))
            added.append((start, end, kind))
    return base, sorted(base + added, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def redact(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind; overlapping spans are replaced once, by the kind of the first."""
    out, last = [], 0
    for start, end, kind in spans:
        if start >= last:
            out += [text[last:start], f"[{kind.upper()}]"]
        last = max(last, end)
    return "".join([*out, text[last:]])


def find_personal_data(docs: DataFrame, keep: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text", redacted: bool = False) -> DataFrame:
    """Per row: the id (or the columns ``keep``), counts by kind of base spans, base_sha256, spans (all, as kind:start:end in code points),
    n_added and, if asked for, the text with all spans redacted.

    One pass without a shuffle over whole texts. Null or empty text has no spans (redacted: stays null or empty); a null id stays; each row
    gives one row, repeated or not; no rows give no rows; other columns are ignored, and a column of ``keep`` with the name of a result
    gives way to it.
    """
    added = [(f"n_{k}", pa.int64()) for k in KINDS] + [("base_sha256", pa.string()), ("spans", pa.string()), ("n_added", pa.int64())] + [("__redacted", pa.string())] * redacted
    own = {n for n, _ in added} | {"__text"}
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("__text")) if keep is None else docs.select(*(c for c in keep if c not in own), F.col(text_col).alias("__text"))
    keep = [c for c in given.columns if c != "__text"]
    rows = given.withColumn("__text", F.col("__text").cast("string"))
    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema.fields] + [f"`{n}` {'long' if t == pa.int64() else 'string'}" for n, t in added])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: dict[str, list] = {n: [] for n, _ in added}
            nulls = batch.column(batch.schema.get_field_index("__text")).is_null().to_pylist()
            for data, null in zip(texts_of(batch, "__text"), nulls, strict=True):
                text = data.decode()
                base, spans = all_spans(text)
                for k in KINDS:
                    columns[f"n_{k}"].append(sum(s[2] == k for s in base))
                columns["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
                columns["spans"].append(joined(spans))
                columns["n_added"].append(len(spans) - len(base))
                if redacted:
                    columns["__redacted"].append(None if null else redact(text, spans))
            schema = pa.schema([batch.schema.field(batch.schema.get_field_index(c)) for c in keep] + added)
            arrays = [batch.column(batch.schema.get_field_index(c)) for c in keep] + [pa.array(columns[n], t) for n, t in added]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return rows.mapInArrow(find, ddl)
