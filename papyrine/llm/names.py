"""Variant spellings of names (problem 2): which spellings belong to one person.

Spellings are brought to forms (case, accents, titles, marks and the order of parts undone). Forms are vectors of character
n-grams (each with the first letter of another part) weighted by rarity, and pairs of forms above a cosine threshold are found by a distributed sparse join: a form is
sent only to the shards of the rare n-grams without which no partner could reach the threshold. A similarity of parts
(equal, typing error, nickname, initial) then scores each pair, and average-linkage clustering of the forms of one surname
decides which are one person. An abbreviated spelling ("Novak A.") is first written out with the given names that its own
records show (the author's id, ORCID or place in an article), so it stands for each of its bearers; only where no record
shows one is it clustered as it is.
"""

from __future__ import annotations

import heapq
import re
import unicodedata
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papyrine.llm.features import Sparse, char_ngrams
from papyrine.session import checkpointed, read_table

#: A feature's number is a letter (5 bits) and a hashed n-gram of GRAM characters (the rest). Parts are hashed to PARTS_BITS.
BITS, GRAM_BITS, GRAM, PARTS_BITS = 20, 15, 4, 17
#: Least cosine of two forms' vectors, least similarity of parts, and least average similarity of clusters.
COSINE, SIMILARITY, LINKAGE = 0.2, 0.6, 0.5
#: Least similarity of parts of a pair that needs support (a common id, ORCID or place), and the factor on pairs of which one
#: is abbreviated and lacks a part of the other, or that differ in a particle or a second surname: initials and surnames are
#: mostly given whole ("Novak A." is seldom "Anna Maria Novak").
SUPPORTED, LACKING = 0.3, 0.5
#: How many times rarer than a given name a typing error of it is at least.
TYPING_ERROR = 8
#: Power of the inverse document frequency in the weights: rare n-grams, mostly of surnames, count most.
RARITY = 5.0
#: Forms a shard is made for, and pairs compared at a time.
SHARD_FORMS, PAIRS = 20_000, 2_000_000

#: Titles and suffixes; letters that no decomposition reaches; digraphs that stand for an accented letter.
TITLES = {"dr", "prof", "professor", "md", "phd", "msc", "bsc", "jr", "sr", "ii", "iii", "mr", "mrs", "ms", "dipl", "ing", "mag", "habil", "doc"}
LETTERS = str.maketrans({"ß": "ss", "ø": "o", "ł": "l", "đ": "d", "æ": "ae", "œ": "oe", "ı": "i", "þ": "th", "ð": "d"})
DIGRAPHS = [("sch", "s"), ("sh", "s"), ("ch", "c"), ("zh", "z"), ("oe", "o"), ("ue", "u"), ("ae", "a"), ("ij", "i"), ("ss", "s")]
#: Short forms of given names.
NICKNAMES = {
    "al": "albert alan alexander", "alex": "alexander alexandra aleksandra alessandra aleksander", "ales": "aleksander alexander", "ana": "anne", "andi": "andreas andrej", "andy": "andrew andreas andrei", "annie": "anne", "tone": "anton", "toni": "anton antonio anthony", "tony": "anthony anton antonio",
    "bea": "beatriz beatrice", "becky": "rebecca", "becca": "rebecca", "ben": "benjamin", "benny": "benjamin", "bert": "albert robert", "beth": "elisabeth elizabeth", "beti": "elizabeta", "betka": "elizabeta", "betty": "elisabeth elizabeth elizabeta", "bill": "william", "billy": "william", "bob": "robert", "bobby": "robert", "rob": "robert", "robbie": "robert", "bogo": "bogdan",
    "cathy": "catherine katherine", "charlie": "charles", "chris": "christopher christian christine", "kit": "christopher", "concha": "concepcion", "kees": "cornelis", "cor": "cornelis", "dan": "daniel", "danny": "daniel", "dave": "david", "deb": "deborah", "debbie": "deborah", "dick": "richard", "rick": "richard", "rich": "richard", "richie": "richard", "dima": "dmitri", "mitja": "dmitri dimitrij", "dora": "teodora theodora", "doris": "dolores", "lola": "dolores",
    "ed": "edward", "eddie": "edward", "ned": "edward", "ted": "theodore edward", "teddy": "theodore edward", "theo": "theodore", "teo": "teodora theodore", "ella": "elisabeth", "else": "elisabeth", "elsa": "elisabeth", "lisa": "elisabeth", "lisbeth": "elisabeth", "lisl": "elisabeth", "liesl": "elisabeth", "sissi": "elisabeth", "liz": "elisabeth elizabeth", "lizzie": "elisabeth elizabeth", "eliza": "elizabeta elisabeth", "quique": "enrique", "kike": "enrique", "fred": "frederick friedrich", "freddy": "frederick", "fritz": "friedrich", "franci": "franc", "france": "franc", "frank": "franc francis", "franz": "franc", "paco": "francisco", "pancho": "francisco", "curro": "francisco", "cesco": "francesco", "franco": "francesco", "ciccio": "francesco", "frenk": "franc",
    "beppe": "giuseppe", "peppe": "giuseppe", "pino": "giuseppe", "gianni": "giovanni", "nino": "giovanni", "vanni": "giovanni", "greg": "gregory", "memo": "guillermo", "guille": "guillermo", "gunter": "gunther", "hans": "johannes", "hannes": "johannes", "jan": "johannes janez", "heini": "heinrich", "heiner": "heinrich", "heinz": "heinrich", "harry": "henry heinrich", "henk": "hendrik", "rik": "hendrik", "inge": "ingrid", "ioan": "ioana", "vanja": "ivan",
    "jim": "james", "jimmy": "james", "jamie": "james", "janko": "janez", "jaka": "jakob", "jen": "jennifer", "jenny": "jennifer", "joe": "joseph", "joey": "joseph", "jo": "joseph", "sepp": "josef joseph", "jupp": "josef", "joze": "josef jozef", "pepca": "jozefa", "pepi": "josef jozefa", "pepe": "jose", "chepe": "jose", "jon": "jonathan", "jonny": "jonathan", "jack": "john", "jurij": "jurgen", "jorg": "jurgen", "kate": "katherine", "kathy": "katherine", "katie": "katherine", "kati": "katherine", "kay": "katherine", "lena": "magdalena helena", "magda": "magdalena", "leni": "magdalena helena", "malena": "magdalena", "ludi": "ludwig", "lutz": "ludwig", "luigi": "luis", "lucho": "luis",
    "maggie": "margaret", "meg": "margaret", "peggy": "margaret", "greta": "margaret", "marge": "margaret", "maria": "marija", "mara": "marija", "marica": "marija", "micka": "marija", "mojci": "mojca", "matt": "matthew", "matty": "matthew", "mati": "matej", "matic": "matej", "max": "maximilian", "mike": "michael", "mick": "michael", "mihi": "michael", "miha": "mihael", "nat": "natalia", "natasa": "natalia", "natasha": "natalia", "tasa": "natasa", "tasha": "natalia natasha", "talia": "natalia", "nick": "nicholas", "nico": "nicholas", "nicky": "nicholas", "klaus": "nicholas", "nace": "ignacij", "olya": "olga", "olja": "olga",
    "pat": "patricia patrick", "patty": "patricia", "trish": "patricia", "tricia": "patricia", "pete": "peter", "piet": "pieter", "pia": "olimpia", "rafa": "rafael", "rok": "rochus", "sam": "samuel", "sammy": "samuel", "sandi": "aleksander aleksandra", "sandra": "alessandra aleksandra alexandra", "sanja": "aleksandra", "sasa": "alexander aleksandra aleksander", "sasha": "alexander aleksandra", "saso": "aleksander", "serge": "sergei", "seryozha": "sergei", "steve": "steven", "sue": "susan", "susie": "susan", "suzy": "susan", "spelca": "spela", "thom": "thomas", "tom": "thomas", "tommy": "thomas", "urh": "ulrik", "urska": "ursula", "ursa": "urska", "will": "william", "liam": "william", "bill ": "william", "wim": "willem", "mina": "wilhelmina", "willa": "wilhelmina", "willie": "william", "wolf": "wolfgang", "wolfi": "wolfgang", "xiao": "xiaoming", "zoe": "zoja", "ziga": "sigismund",
}
_TOKEN = re.compile(r"[^\W\d_]+(?:[-'’][^\W\d_]+)*")


PARTICLES = {"da", "de", "del", "den", "der", "di", "do", "dos", "du", "la", "le", "ten", "ter", "van", "von", "zu"}
_INITIAL = re.compile(r"[^\W\d_](-[^\W\d_])?$")


def _plain(token: str) -> str:
    """A part without accents. An initial keeps its accent."""
    token = token.lower()
    if len(token) == 1:
        return unicodedata.normalize("NFC", token)
    token = "".join(c for c in unicodedata.normalize("NFKD", token.translate(LETTERS)) if not unicodedata.combining(c))
    if len(token) > 3:
        for long, short in DIGRAPHS:
            token = token.replace(long, short)
    return token


_FORMAL = {_plain(k.strip()): frozenset(_plain(x) for x in v.split()) for k, v in NICKNAMES.items()}


def form(name: str) -> str:
    """The form of a spelling: its parts in lower case without accents, titles and marks, given names first where a comma or
    closing initials show which they are. Initials that stand together ("J.D.", "PP") are parts of their own; initials and
    short names joined by a hyphen ("A-M.", "Anne-Marie") are one part."""
    name = unicodedata.normalize("NFC", name)
    pieces = name.split(",", 1)
    found: list[list[str]] = []
    shouting = sum(t.isupper() for t in _TOKEN.findall(name) if len(t) > 3) * 2 > sum(len(t) > 3 for t in _TOKEN.findall(name))
    for piece in pieces:
        own, tokens = [], _TOKEN.findall(piece)
        for token in tokens:
            low = _plain(token.replace("'", "").replace("’", ""))
            if low in TITLES and not (len(own) == 1 and token.isupper() and len(token) == 2 and len(tokens) == 2):
                continue
            bits = [x for x in token.split("-") if x]
            if len(bits) == 2 and max(map(len, bits)) <= 6:
                own.append("-".join(_plain(x) for x in bits))
            elif len(bits) > 1:
                own += [_plain(x) for x in bits]
            elif 2 <= len(token) <= 3 and token.isupper() and low not in PARTICLES and (not shouting or not set(low) & set("aeiouy")):
                own += [_plain(x) for x in token]
            elif low:
                own.append(low)
        found.append(own)
    if len(found) == 2 and found[1]:
        return " ".join(found[1] + found[0])
    own = found[0]
    last = len(own)
    while last > 1 and (_INITIAL.match(own[last - 1]) or (own[last - 1] in PARTICLES and _INITIAL.match(own[last - 2]))):
        last -= 1
    return " ".join(own[last:] + own[:last])


def one_edit(a: str, b: str) -> bool:
    """Whether one letter changed, left out, added, or two neighbours exchanged turns a into b."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return a == b
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1 :] == b[i + 1 :] or (a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :])
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return long[i + 1 :] == short[i:]


def nickname(a: str, b: str) -> bool:
    """Whether one is a short form of the other, or both are short forms of one name."""
    x, y = _FORMAL.get(a, frozenset()), _FORMAL.get(b, frozenset())
    return b in x or a in y or bool(x & y)


def _given(t: str, u: str, common: PartCounts) -> float:
    """How well two parts that may be given names agree, from 0 to 1."""
    if t == u:
        return 1.0 if len(t) > 1 else 0.95
    if _INITIAL.match(t) or _INITIAL.match(u):
        short, long = (t, u) if len(t) < len(u) else (u, t)
        if len(long) == 1:
            return 0.0
        if short == long[0] or any(x[0] == short for x in _FORMAL.get(long, ())):
            return 0.85
        return 0.75 if not short.isascii() and _plain(short + short)[0] == long[0] else 0.0
    if nickname(t, u):
        return 0.9
    if min(len(t), len(u)) > 2 and one_edit(t, u):  # a typing error is much rarer than the name it stands for
        few, many = sorted((common.get(t, 0), common.get(u, 0)))
        return 0.9 if not hasattr(common, "is_given") or few * TYPING_ERROR <= many else 0.0
    return 0.0


def _place(part: str) -> int:
    return zlib.crc32(part.encode()) & (1 << PARTS_BITS) - 1


class PartCounts:
    """In how many forms a part occurs, by its hash."""

    def __init__(self, counts: np.ndarray) -> None:
        self.counts = counts

    def get(self, part: str, default: int = 0) -> int:
        return int(self.counts[_place(part)])


class RoleCounts(PartCounts):
    """Also in how many names a part is given, and in how many it is a surname."""

    def __init__(self, counts: np.ndarray, given: np.ndarray, family: np.ndarray) -> None:
        self.counts, self.given, self.family = counts, given, family
        self.known: dict[str, bool] = {}

    def is_given(self, part: str) -> bool:
        own = self.known.get(part)
        if own is None:
            place = _place(part)
            own = self.known[part] = bool(self.given[place] > self.family[place])
        return own


def written_out(own: str, firsts: list[str], known: dict[str, str] | None = None) -> list[str]:
    """The form `own` with its leading initial written out by each of the first names that it may stand for; itself if it
    begins with no initial or no first name fits. known keeps forms of first names."""
    known = {} if known is None else known
    parts, out = own.split(" "), []
    if not _INITIAL.match(parts[0]):
        return [own]
    for first in firsts:
        if first not in known:
            known[first] = form(first)
        full = known[first].split(" ")
        if not full[0] or _INITIAL.match(full[0]) or not {parts[0][0], _plain(parts[0][0] * 2)[0]} & _letters(full[0]):
            continue
        rest = parts[1:]
        if len(full) > 1 and "-" not in parts[0] and rest and _INITIAL.match(rest[0]) and full[1][0] == rest[0][0]:
            rest = rest[1:]
        out.append(" ".join(full + rest))
    return sorted(set(out)) or [own]


def similarity(a: list[str], b: list[str], common: PartCounts) -> tuple[float, str]:
    """How well the parts of two forms agree, from 0 to 1, and the surname they agree in with a first letter. common: in how
    many forms a part occurs, and (is_given, if it can tell) whether it is mostly a given name. The surname is the rarest
    part in both that is no given name, else the rarest of one with a typing error. The first of the other parts must agree,
    and one must have no part left that the other contradicts."""
    return _agreement(_Sides(a, common), _Sides(b, common), common)


class _Sides:
    """What similarity needs of a form's parts: they without particles and hyphens, which may be surnames, the particles, and
    whether the form is abbreviated."""

    __slots__ = ("parts", "family", "particles", "abbreviated")

    def __init__(self, own: list[str], common: PartCounts) -> None:
        self.parts = [x for t in own if t not in PARTICLES for x in t.split("-")]
        self.family = _family(self.parts, common)
        self.particles = sorted(PARTICLES.intersection(own))
        self.abbreviated = abbreviated(own)


def _agreement(a: _Sides, b: _Sides, common: PartCounts) -> tuple[float, str]:
    score, surname, roles = 1.0, "", hasattr(common, "is_given")
    left, right, family = a.parts[:], b.parts[:], (a.family, b.family)
    shared = [t for t in family[0] if t in family[1]]
    if shared:
        surname = min(shared, key=lambda t: (common.get(t, 0), t))
        left.remove(surname)
        right.remove(surname)
    else:
        near = [(t, u) for t in family[0] for u in family[1] if len(t) > 4 and len(u) > 4 and one_edit(t, u)]
        if near:
            t, u = min(near, key=lambda x: (min(common.get(w, 0) for w in x), x))
            surname, score = max(t, u, key=lambda w: (common.get(w, 0), w)), score * 0.9
            left.remove(t)
            right.remove(u)
    if not surname or not left or not right:
        return 0.0, surname
    for t in [t for t in left[:] if t in family[0] and len(t) > 4]:  # a further surname in both
        u = next((u for u in right if u in family[1] and (t == u or (len(u) > 4 and one_edit(t, u)))), None)
        if u is not None and len(left) > 1 and len(right) > 1 and (roles or (left[0] != t and right[0] != u)):
            left.remove(t)
            right.remove(u)
    if roles:  # further surnames of one of them stand behind its given names
        left, right = (sorted(own, key=lambda t, f=f: t in f) for own, f in ((left, family[0]), (right, family[1])))
    first = min(_plain(t + t)[0] if len(t) == 1 else t[0] for t in (left[0], right[0]))
    agree = _given(left.pop(0), right.pop(0), common)
    if not agree:
        return 0.0, surname
    score *= agree
    for t in list(left):
        u, agree = max(((u, _given(t, u, common)) for u in right), key=lambda x: x[1], default=("", 0.0))
        if agree:
            left.remove(t)
            right.remove(u)
            score *= agree
    if left and right:
        return 0.0, surname
    if a.particles != b.particles:
        score *= LACKING
    if (left and b.abbreviated) or (right and a.abbreviated) or (roles and (any(t in family[0] for t in left) or any(t in family[1] for t in right))):
        score *= LACKING
    return score * 0.97 ** (len(left) + len(right)), f"{surname} {first}"


def _family(parts: list[str], common: PartCounts) -> list[str]:
    """The parts that may be surnames: no initials, and none that is mostly a given name, unless no other is there."""
    long = [t for t in parts if len(t) > 1]
    own = [t for t in long if not common.is_given(t)] if hasattr(common, "is_given") else long
    return own or long[-1:]


def abbreviated(parts: list[str]) -> bool:
    """A form with at most one part that is no initial."""
    return sum(p not in PARTICLES and not _INITIAL.match(p) for p in parts) < 2


def _letters(part: str) -> set[str]:
    """The first letters under which a part may appear: its own, and those of names it is short for."""
    return {(x[0] if x[0].isascii() else _plain(x + x)[0]) for x in (part, *_FORMAL.get(part, ()))}


def weights(forms: list[str], frequencies: np.ndarray | None, documents: int) -> Sparse:
    """Each form's different features, in order of their numbers, with weights whose squares sum to one (without
    frequencies: with equal weights); features of no other form are left out. A feature is an n-gram of a part together with the
    first letter of another part. Initials have none, nor have particles of two letters, which are no surnames (see _Sides)."""
    texts, letter, form_of = [], [], []
    for i, f in enumerate(forms):
        parts = f.split(" ")
        firsts = [_letters(p) for p in parts]
        for k, part in enumerate(parts):
            if len(part) > 2 or (len(part) == 2 and part not in PARTICLES):
                for c in set().union(*(x for j, x in enumerate(firsts) if j != k)):
                    texts.append(part.replace("-", " "))
                    letter.append(ord(c))
                    form_of.append(i)
    rows = char_ngrams(texts, (GRAM,), GRAM_BITS)
    mixed = rows.feature.astype(np.int64) | np.array(letter, np.int64)[rows.owner()] % 32 << GRAM_BITS
    key = np.unique(np.array(form_of, np.int64)[rows.owner()] << BITS | mixed) if len(rows.feature) else np.zeros(0, np.int64)
    if frequencies is not None:
        key = key[frequencies[key & (1 << BITS) - 1] > 1]
    feature, owner = (key & (1 << BITS) - 1).astype(np.int32), key >> BITS
    weight = np.ones(len(key)) if frequencies is None else np.log((1 + documents) / np.maximum(1, frequencies[feature])) ** RARITY + 1e-9
    length = np.sqrt(np.bincount(owner, weight**2, len(forms)))
    return Sparse(feature, (weight / length[owner]).astype(np.float32), np.bincount(owner, minlength=len(forms)))


def remainders(rows: Sparse) -> np.ndarray:
    """Of each entry the squared length of its row from it on, in the order from rare n-grams to frequent ones that all rows
    share. Two rows whose first common entry has remainders a and b have a cosine of at most sqrt(a * b)."""
    owner = rows.owner()
    order = np.lexsort((rows.feature, -rows.weight, owner))
    square = rows.weight[order].astype(np.float64) ** 2
    before = np.cumsum(square) - square
    base = before[rows.starts[owner[order]]] if len(order) else before
    out = np.zeros(len(order))
    out[order] = 1 - (before - base)
    return out


def prefixes(rows: Sparse) -> np.ndarray:
    """Which entries are in their row's prefix: the rarest n-grams, as many as leave less than COSINE to all others. Two
    rows of at least that cosine share an n-gram of both prefixes."""
    return remainders(rows) >= COSINE**2 - 1e-6


def _unique(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def join_shard(forms: list[str], grams: np.ndarray | None, frequencies: np.ndarray, documents: int, common: PartCounts) -> list[tuple[str, str, float, str]]:
    """(form, form, similarity, block) of the pairs whose rarest common feature is one for which grams is true: of all shards
    where a pair meets, one gives it. A pair is only looked at where the rest of both rows can reach the threshold."""
    sides: dict[int, _Sides] = {}
    rows = weights(forms, frequencies, documents)
    rest = remainders(rows)
    prefix = np.flatnonzero(rest >= COSINE**2 - 1e-6)
    entry = prefix if grams is None else prefix[grams[rows.feature[prefix]]]
    short_key = rows.owner()[prefix].astype(np.int64) << BITS | rows.feature[prefix]
    ranked = prefix[np.lexsort((-rest[prefix], rows.owner()[prefix]))]  # from rare to frequent
    short = Sparse(rows.feature[ranked], rows.weight[ranked], np.bincount(rows.owner()[prefix], minlength=len(forms)))
    owner, feature, rest = rows.owner()[entry], rows.feature[entry], rest[entry]
    order = np.argsort(feature, kind="stable")
    owner, feature, rest = owner[order], feature[order], rest[order]
    # each entry meets the entries after it in its posting list
    end = np.searchsorted(feature, feature, side="right")
    meets = end - np.arange(len(feature)) - 1
    found: list[np.ndarray] = []
    cuts = np.searchsorted(np.cumsum(meets), np.arange(PAIRS, meets.sum() + PAIRS, PAIRS)) if len(meets) else []
    at = 0
    for cut in [*np.asarray(cuts, int).tolist(), len(meets)]:
        cut = min(cut + 1, len(meets))
        own = meets[at:cut]
        first = np.repeat(np.arange(at, cut), own)
        second = first + 1 + np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
        reach = rest[first] * rest[second] >= COSINE**2 - 1e-6
        x, y = owner[first[reach]], owner[second[reach]]
        found.append(_unique(np.minimum(x, y).astype(np.int64) * len(forms) + np.maximum(x, y)))
        at = cut
    pairs = _unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    key = rows.owner().astype(np.int64) << BITS | rows.feature
    out = []
    for part in np.array_split(pairs, max(1, len(pairs) // 200_000)):
        x, y = part // len(forms), part % len(forms)
        left = rows.take(x)
        wanted = np.repeat(y, left.sizes) << BITS | left.feature
        place = np.minimum(np.searchsorted(key, wanted), max(0, len(key) - 1))
        product = np.where(key[place] == wanted, rows.weight[place] * left.weight, 0) if len(key) else np.zeros(0)
        good = np.bincount(left.owner(), product, len(part)) >= COSINE
        x, y = x[good], y[good]
        if grams is not None and len(x):
            left = short.take(x)
            wanted = np.repeat(y, left.sizes) << BITS | left.feature
            there = short_key[np.minimum(np.searchsorted(short_key, wanted), len(short_key) - 1)] == wanted
            place = np.minimum.reduceat(np.where(there, np.arange(len(there)), len(there) - 1), left.starts)
            own = grams[left.feature[place]]
            x, y = x[own], y[own]
        for i, j in zip(x.tolist(), y.tolist(), strict=True):
            i, j = (i, j) if forms[i] < forms[j] else (j, i)
            for k in (i, j):
                if k not in sides:
                    sides[k] = _Sides(forms[k].split(" "), common)
            score, block = _agreement(sides[i], sides[j], common)
            if score >= SUPPORTED:
                out.append((forms[i], forms[j], score, block))
    return out


def cluster(pairs: list[tuple[str, str, float]]) -> list[bool]:
    """Which pairs of one surname hold: those within a cluster of average linkage (a missing pair counts 0)."""
    names = sorted({x for a, b, _ in pairs for x in (a, b)})
    number = {x: i for i, x in enumerate(names)}
    total: list[dict[int, float]] = [{} for _ in names]
    for a, b, s in pairs:
        i, j = number[a], number[b]
        total[i][j] = total[j][i] = s
    label = list(range(len(names)))
    members = [[i] for i in label]
    # the closest clusters come first; an entry counts while it is what the clusters' average is now
    queue = [(-s, i, j) for i, own in enumerate(total) for j, s in own.items() if i < j and s >= LINKAGE]
    heapq.heapify(queue)
    while queue:
        average, i, j = heapq.heappop(queue)
        if j not in total[i] or -average != total[i][j] / (len(members[i]) * len(members[j])):
            continue
        for k, s in total[j].items():
            if k != i:
                total[i][k] = total[k][i] = total[i].get(k, 0) + s
                del total[k][j]
        total[i].pop(j, None)
        total[j] = {}
        members[i] += members[j]
        members[j] = []
        for k, s in total[i].items():
            if (average := s / (len(members[i]) * len(members[k]))) >= LINKAGE:
                heapq.heappush(queue, (-average, min(i, k), max(i, k)))
    for i, own in enumerate(members):
        own.sort()
        for k in own:
            label[k] = i
    return [label[number[a]] == label[number[b]] for a, b, _ in pairs]


def spellings(crossref: DataFrame, elsevier: DataFrame) -> DataFrame:
    """(name): every different non-blank spelling, exactly as stored."""
    one = crossref.select(F.concat_ws(" ", "author_given_name", "author_family_name").alias("name"))
    other = elsevier.select(F.col("author_indexed_name").alias("name"))
    return one.unionByName(other).where("name is not null and trim(name) <> ''").distinct()


def bearers(crossref: DataFrame, elsevier: DataFrame) -> DataFrame:
    """(name, bearer, firsts): every different non-blank spelling with each bearer that its records show and the first names
    of that bearer, the most frequent of each first letter.

    A bearer is the author id at the same place of the same article (where there is only one), else the ORCID. A spelling
    also has one without first names and of its own for its records that show none.
    """
    name = F.concat_ws(" ", "author_given_name", "author_family_name")
    doi = F.xxhash64(F.lower(F.trim("article_doi")))
    orcid = F.nullif(F.regexp_replace(F.upper(F.regexp_extract("author_orcid", r"(\d{4}-?\d{4}-?\d{4}-?\d{3}[\dXx])", 1)), "-", ""), F.lit(""))
    blank = "name is not null and trim(name) <> ''"
    other = elsevier.select(doi.alias("d"), F.col("author_sequence").try_cast("int").alias("i"), F.col("author_indexed_name").alias("name"), F.concat(F.lit("id "), "author_id").alias("bearer"), F.col("author_first_name").alias("first")).where(blank)
    places = other.where("d is not null and i is not null and bearer is not null").groupBy("d", "i").agg(F.min("bearer").alias("placed"), F.max("bearer").alias("most")).where("placed = most").drop("most")
    one = crossref.select(doi.alias("d"), F.col("author_sequence_index").cast("int").alias("i"), name.alias("name"), F.concat(F.lit("orcid "), orcid).alias("orcid"), F.col("author_given_name").alias("first")).where(blank).distinct()
    one = one.join(places, ["d", "i"], "left")
    firsts = other.select("bearer", "first").unionByName(one.select(F.col("placed").alias("bearer"), "first")).unionByName(one.select(F.col("orcid").alias("bearer"), "first"))
    firsts = firsts.where(F.col("bearer").isNotNull() & F.col("first").rlike(r"\p{L}{2}")).groupBy("bearer", "first").count()
    firsts = firsts.groupBy("bearer", F.upper(F.substring(F.regexp_replace("first", r"\P{L}+", ""), 1, 1)).alias("letter")).agg(F.max_by("first", F.struct("count", "first")).alias("first"))
    firsts = firsts.groupBy("bearer").agg(F.sort_array(F.collect_list("first")).alias("firsts"))
    own = F.concat(F.lit("name "), "name")
    known = other.select("name", F.coalesce("bearer", own).alias("bearer")).unionByName(one.select("name", F.coalesce("placed", "orcid", own).alias("bearer"))).distinct()
    return known.join(firsts, "bearer", "left").select("name", "bearer", "firsts")


def roles(crossref: DataFrame, elsevier: DataFrame) -> DataFrame:
    """(given, family): the different pairs of a given name and a surname that the tables' fields hold."""
    one = crossref.select(F.col("author_given_name").alias("given"), F.col("author_family_name").alias("family"))
    return one.unionByName(elsevier.select(F.col("author_first_name").alias("given"), F.col("author_last_name").alias("family"))).distinct()


def _summed(rows: DataFrame, count: Callable, size: int) -> np.ndarray:
    """Over all of rows' batches, the sum of the arrays of `size` numbers that count adds to. At most `size` numbers reach
    the driver; each task sums its own rows first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for at in range(0, len(batch), 20_000):
                count(batch[at : at + 20_000], total)
        used = np.flatnonzero(total)
        yield pd.DataFrame({"place": used.astype("int32"), "n": total[used]})

    rows = rows.mapInPandas(run, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(size, np.int64)
    total[rows["place"].to_numpy(int)] = rows["n"]
    return total


def _counts(forms: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Over all forms: in how many each feature occurs, each part, and how many have features of each letter."""
    parts_at, letters_at = 1 << BITS, (1 << BITS) + (1 << PARTS_BITS)

    def count(batch: pd.DataFrame, total: np.ndarray) -> None:
        some = batch["form"].tolist()
        rows = weights(some, None, 1)
        total[:parts_at] += np.bincount(rows.feature, minlength=parts_at)
        letters = _unique(rows.owner() << 5 | rows.feature >> GRAM_BITS) & 31
        total[letters_at:] += np.bincount(letters, minlength=32)
        hashed = [_place(p) for f in some for p in set(f.split(" "))]
        total[parts_at:letters_at] += np.bincount(np.array(hashed, np.int64), minlength=1 << PARTS_BITS)

    total = _summed(forms, count, letters_at + 32)
    return total[:parts_at], total[parts_at:letters_at], total[letters_at:]


def _role_counts(names: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """In how many of names (given, family) each part is given, and in how many a surname."""

    def count(batch: pd.DataFrame, total: np.ndarray) -> None:
        for at, column in ((0, "given"), (1 << PARTS_BITS, "family")):
            parts = [x for v in batch[column] if v for t in form(v).split(" ") if t not in PARTICLES for x in t.split("-") if len(x) > 1]
            total[at : at + (1 << PARTS_BITS)] += np.bincount(np.array([_place(x) for x in parts], np.int64), minlength=1 << PARTS_BITS)

    total = _summed(names, count, 2 << PARTS_BITS)
    return total[: 1 << PARTS_BITS], total[1 << PARTS_BITS :]


def link(names: DataFrame, fields: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """For different spellings (name; as bearers gives them also with bearer and firsts): their forms (name, form), the pairs
    of different forms of one person (a, b, similarity), each once with a < b, and in the same way the pairs that would need
    support and have none. fields: (given, family), from which it is counted which parts are given names.

    A pair of forms has support if one bearer has both; its similarity then moves half way to 1, and average linkage decides
    about it as about all others. A name without any letter has an empty form and no partner. No candidate is capped: a shard
    holds all forms with a prefix feature of its own, and shards are made for SHARD_FORMS forms by letter and n-gram.
    """
    spark = names.sparkSession
    if "firsts" not in names.columns:
        names = names.select("name", F.lit(None).cast("string").alias("bearer"), F.lit(None).cast("array<string>").alias("firsts"))

    def to_forms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, str] = {}
        for batch in batches:
            if len(known) > 100_000:
                known.clear()
            own = {x: form(x) for x in batch["name"].unique()}
            forms = [written_out(own[x], [] if f is None else list(f), known) for x, f in zip(batch["name"], batch["firsts"], strict=True)]
            many = [len(x) for x in forms]
            yield pd.DataFrame({"name": batch["name"].repeat(many).to_numpy(), "bearer": batch["bearer"].repeat(many).to_numpy(), "form": [x for own in forms for x in own]})

    borne = checkpointed(names.mapInPandas(to_forms, "name string, bearer string, form string"))
    formed = borne.select("name", "form").distinct()
    forms = checkpointed(borne.where("form <> ''").select("form").distinct())
    frequencies, parts, letters = _counts(forms)
    given = _role_counts(fields) if fields is not None else None
    total = int(forms.count())
    splits = np.maximum(1, -(-letters // SHARD_FORMS))
    offsets = np.cumsum(splits) - splits
    shared = spark.sparkContext.broadcast((frequencies.astype(np.int32), parts.astype(np.int32), given, splits, offsets, total))

    def shard_of(feature: np.ndarray, splits: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        letter = feature >> GRAM_BITS
        return offsets[letter] + (feature & (1 << GRAM_BITS) - 1) % splits[letter]

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frequencies, _, _, splits, offsets, total = shared.value
        for batch in batches:
            own = batch["form"].to_numpy()
            for at in range(0, len(own), 20_000):
                some = own[at : at + 20_000]
                rows = weights(some.tolist(), frequencies, total)
                keep = prefixes(rows)
                key = _unique(rows.owner()[keep] << 32 | shard_of(rows.feature[keep].astype(np.int64), splits, offsets))
                yield pd.DataFrame({"shard": (key & (1 << 32) - 1).astype("int32"), "form": some[key >> 32]})

    def join(frame: pd.DataFrame) -> pd.DataFrame:
        frequencies, parts, given, splits, offsets, total = shared.value
        grams = shard_of(np.arange(1 << BITS), splits, offsets) == frame["shard"].iloc[0]
        counts = PartCounts(parts) if given is None else RoleCounts(parts, *given)
        out = join_shard(frame["form"].tolist(), grams, frequencies, total, counts)
        return pd.DataFrame(out, columns=["a", "b", "similarity", "block"])

    schema = "a string, b string, similarity double, block string"
    # the number of tasks is set, as rows alone don't tell the time a shard takes
    tasks = int(min(splits.sum(), 16 * spark.sparkContext.defaultParallelism))
    pairs = checkpointed(forms.mapInPandas(route, "shard int, form string").repartition(tasks, "shard").groupBy("shard").applyInPandas(join, schema))
    bears = borne.where("bearer is not null and form <> ''").select("form", "bearer").distinct()
    supported = pairs.select("a", "b").join(bears.withColumnRenamed("form", "a"), "a").join(bears.withColumnRenamed("form", "b"), ["b", "bearer"]).select("a", "b").distinct()
    judged = pairs.join(supported.withColumn("supported", F.lit(True)), ["a", "b"], "left")
    judged = judged.withColumn("similarity", F.when(F.col("supported"), (F.col("similarity") + 1) / 2).otherwise(F.col("similarity"))).drop("supported")
    judged = checkpointed(judged)

    def hold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come in order of blocks; a block may go on in the next batch. A block's rows share their forms' texts."""
        rows: list[tuple] = []
        texts: dict[str, str] = {}
        block = None
        for batch in batches:
            kept: list[tuple] = []
            for a, b, s, own in batch.itertuples(index=False, name=None):
                if own != block:
                    kept += held(rows)
                    rows, texts, block = [], {}, own
                rows.append((texts.setdefault(a, a), texts.setdefault(b, b), s))
            yield pd.DataFrame(kept, columns=["a", "b", "similarity"])
        yield pd.DataFrame(held(rows), columns=["a", "b", "similarity"])

    def held(rows: list[tuple]) -> list[tuple]:
        if len(rows) < 2:
            return [row for row in rows if row[2] >= LINKAGE]
        return [row for row, good in zip(rows, cluster(rows), strict=True) if good]

    strong = F.col("similarity") >= SIMILARITY
    blocks = judged.where(strong).select("a", "b", "similarity", "block").repartition("block").sortWithinPartitions("block", "a", "b")
    return formed, blocks.mapInPandas(hold, "a string, b string, similarity double"), judged.where(~strong).drop("block")


def _tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return read_table(spark, sf_dir, "crossref_publication_parsed"), read_table(spark, sf_dir, "elsevier_publication_parsed")


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs of different spellings of one person: those that share a form, and those of two forms that are linked."""
    tables = _tables(spark, sf_dir)
    formed, pairs, _ = link(bearers(*tables), roles(*tables))
    alike = formed.where("form <> ''").groupBy("form").count().where("count > 1").select(F.col("form").alias("a"), F.col("form").alias("b"))
    left = formed.select(F.col("name").alias("x"), F.col("form").alias("a"))
    right = formed.select(F.col("name").alias("y"), F.col("form").alias("b"))
    rows = pairs.select("a", "b").unionByName(alike).join(left, "a").join(right, "b").where("x <> y and (a <> b or x < y)")
    return rows.select(F.least("x", "y").alias("name_a"), F.greatest("x", "y").alias("name_b")).distinct()


def forms_of_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each spelling and form that it stands for: how many spellings the form has, and how many forms are linked
    to it."""
    tables = _tables(spark, sf_dir)
    formed, pairs, _ = link(bearers(*tables), roles(*tables))
    ends = pairs.select(F.explode(F.array("a", "b")).alias("form")).groupBy("form").agg(F.count("*").alias("linked_forms"))
    own = formed.groupBy("form").agg(F.count("*").alias("spellings"))
    return formed.join(own, "form").join(ends, "form", "left").select("name", "form", "spellings", F.coalesce("linked_forms", F.lit(0)).alias("linked_forms"))


def queries() -> dict:
    return {"p2_found": found, "p2_forms": forms_of_names}


def oracle_sql() -> dict[str, str]:
    return {}
