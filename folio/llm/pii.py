"""PII: fixed patterns, and a linear-chain conditional random field over word shapes for what patterns miss.

The base finds e-mail addresses, IPv4 addresses, payment cards and phone numbers by pattern, each kind by itself, in time linear in the
text. The field reads the neighbourhood of every trigger (a digit, an @, or a spelled-out "dot"): its tokens' shapes, lengths, cue words and
spacing, two tokens to each side. It is trained from a small labelled table (labelled_rows), decoded by Viterbi in numpy batches, and adds
the spans it finds that touch no base span: phones without a leading plus, and addresses written out with "at" and "dot".

Edge cases: a null text is empty and has no spans. Spans are in code points, end exclusive. A text may be of any length: the patterns
never go back over a run, and only triggers' neighbourhoods are tokenised; a long one (a table of numbers) is decoded in pieces of 1,024 tokens
that share 128, so memory does not grow with it. Only 0-9 are digits: raised, circled and other scripts' digits
are signs like any other. Repeated rows are kept; an empty table gives no rows; input columns named like the outputs are replaced.
"""

from __future__ import annotations

import re
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.llm.common import small_batches, without

KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match of these ends with a run of digits, so that no match can begin inside one; ++ keeps the scan linear.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _luhn(digits: str) -> bool:
    twice = "0246813579"
    return sum(int(twice[int(c)]) if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10 == 0


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """Spans of each kind, in order."""
    out: list[list[tuple[int, int]]] = [[], [], [], []]
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out[0].append((start, m.end()))
        done = m.end() if m else at + 1
        at = text.find("@", done)
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out[1].append(m.span())
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "") if m.end() - m.start() < 40 else ""
        if 13 <= len(digits) <= 19 and _luhn(digits):
            out[2].append(m.span())
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                out[3].append(m.span())
    return out


# ---- the field ---------------------------------------------------------------------------------

TAGS = ["O", *(f"{b}-{k}" for k in KINDS for b in "BI")]
CUES = "at dot com net org edu info mail email phone tel telephone call fax mobile cell ring reach write address contact number version page room order date born".split()
_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|[^\s]")
_TRIGGER = re.compile(r"[0-9@]|\bdot\b|\bDOT\b")
REACH = 2  # tokens to each side whose shapes count
_PUNCT = "@.+-()[]{}<>:;,/\\#=\"'!?%&*_$|~"
#: Feature numbers: kinds of token, lengths and case, cue words, space before, digit runs.
N_FEATURES = 200


def shape(token: str, spaced: bool) -> list[int]:
    """The numbers of a token's five features."""
    if "0" <= token[0] <= "9":
        n = min(len(token), 20)
        return [0, 40 + n, 150, 100 + spaced, 110 + (n if n > 3 or int(token) <= 255 else 21)]
    if token[0].isalpha():
        case = 0 if token.islower() else 1 if token.istitle() else 2 if token.isupper() else 3
        low = token.lower()
        return [1, 65 + case * 8 + min(7, len(token) // 2), 151 + CUES.index(low) if low in CUES else 150, 100 + spaced, 140 + case]
    return [2 + (_PUNCT.find(token) + 1), 98, 150, 100 + spaced, 145]


def features(text: str, spans: list[tuple[int, int]]) -> np.ndarray:
    return np.array([shape(text[s:e], s == 0 or text[s - 1].isspace()) for s, e in spans], np.int64).reshape(-1, 5)


def tokens(text: str, start: int, end: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Features and spans of the tokens of text[start:end]."""
    spans = [m.span() for m in _TOKEN.finditer(text, start, end)]
    return features(text, spans), spans


def neighbourhoods(text: str, reach: int = 48) -> list[tuple[int, int]]:
    """Ranges around triggers, ending at white space, merged where they meet."""
    out: list[tuple[int, int]] = []
    for m in _TRIGGER.finditer(text):
        s, e = max(0, m.start() - reach), min(len(text), m.end() + reach)
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], e)
        else:
            out.append((s, e))
    fitted = []
    for s, e in out:
        for _ in range(reach):  # a cut word would have another shape
            if s > 0 and not text[s - 1].isspace():
                s -= 1
        for _ in range(reach):
            if e < len(text) and not text[e].isspace():
                e += 1
        fitted.append((s, e))
    return fitted


class Field:
    """weights[offset, feature, tag] and moves[tag, tag]; a start or an O is never followed by I of a kind that did not begin."""

    def __init__(self) -> None:
        k = len(TAGS)
        self.weights = np.zeros((2 * REACH + 1, N_FEATURES, k))
        self.moves = np.zeros((k, k))
        self.barred = np.zeros((k, k))
        for j, tag in enumerate(TAGS):
            if tag[0] == "I":
                self.barred[[i for i, t in enumerate(TAGS) if t[2:] != tag[2:]], j] = -1e9
        self.first = np.where([t[0] == "I" for t in TAGS], -1e9, 0.0)

    def emissions(self, ids: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """ids: batch x time x 5; mask: batch x time."""
        b, t, _ = ids.shape
        out = np.zeros((b, t, len(TAGS)))
        for o in range(-REACH, REACH + 1):
            lo, hi = max(0, -o), min(t, t - o)
            if lo < hi:
                part = self.weights[o + REACH][ids[:, lo + o : hi + o]].sum(2)
                out[:, lo:hi] += part * mask[:, lo + o : hi + o, None]
        return out

    def viterbi(self, ids: np.ndarray, mask: np.ndarray) -> np.ndarray:
        e, step = self.emissions(ids, mask), self.moves + self.barred
        b, t, k = e.shape
        score, back = e[:, 0] + self.first, np.zeros((b, t, k), np.int8)
        for i in range(1, t):
            every = score[:, :, None] + step
            back[:, i] = every.argmax(1)
            score = np.where(mask[:, i, None], every.max(1) + e[:, i], score)
            back[:, i][~mask[:, i]] = np.arange(k)
        tags = np.zeros((b, t), np.int64)
        tags[:, -1] = score.argmax(1)
        for i in range(t - 1, 0, -1):
            tags[:, i - 1] = back[np.arange(b), i, tags[:, i]]
        return tags

    def train(self, ids: np.ndarray, mask: np.ndarray, tags: np.ndarray, steps: int = 110, rate: float = 0.1, decay: float = 1e-3) -> None:
        """Maximises the likelihood by Adam over the whole (small) table; the gradient comes from forward-backward."""
        b, t, k = *mask.shape, len(TAGS)
        hot = np.eye(k)[tags] * mask[..., None]
        seen = np.einsum("bti,btj->ij", hot[:, :-1], hot[:, 1:])
        table = np.zeros((b, t, N_FEATURES), np.float32)
        for f in range(5):
            table[np.arange(b)[:, None], np.arange(t)[None], ids[..., f]] += mask
        state = [(p, np.zeros_like(p), np.zeros_like(p)) for p in (self.weights, self.moves)]
        flat = table.reshape(-1, N_FEATURES)
        for n in range(1, steps + 1):
            e = np.zeros((b, t, k))
            for o in range(-REACH, REACH + 1):
                lo, hi = max(0, -o), min(t, t - o)
                e[:, lo:hi] += (flat @ self.weights[o + REACH].astype(np.float32)).reshape(b, t, k)[:, lo + o : hi + o]
            e = np.exp(e - e.max(2, keepdims=True))
            step = np.exp(self.moves + self.barred)
            # scaled forward and backward sums; past its end a row passes its state on
            alpha, beta = np.zeros((b, t, k)), np.ones((b, t, k))
            alpha[:, 0] = e[:, 0] * np.exp(self.first)
            alpha[:, 0] /= alpha[:, 0].sum(1, keepdims=True)
            for i in range(1, t):
                on = (alpha[:, i - 1] @ step) * e[:, i]
                alpha[:, i] = np.where(mask[:, i, None], on / on.sum(1, keepdims=True), alpha[:, i - 1])
            for i in range(t - 2, -1, -1):
                on = (e[:, i + 1] * beta[:, i + 1]) @ step.T
                beta[:, i] = np.where(mask[:, i + 1, None], on / on.sum(1, keepdims=True), beta[:, i + 1])
            p = alpha * beta
            p = p / p.sum(2, keepdims=True) * mask[..., None]
            right = e[:, 1:] * beta[:, 1:]
            norm = np.einsum("bti,ij,btj->bt", alpha[:, :-1], step, right, optimize=True)
            pair = step * np.einsum("bti,btj->ij", alpha[:, :-1] * (mask[:, 1:] / norm)[..., None], right, optimize=True)
            gap, grad = (hot - p), np.zeros_like(self.weights)
            for o in range(-REACH, REACH + 1):
                lo, hi = max(0, -o), min(t, t - o)
                grad[o + REACH] = table[:, lo + o : hi + o].reshape(-1, N_FEATURES).T @ gap[:, lo:hi].reshape(-1, k).astype(np.float32)
            for (x, first, second), g in zip(state, (grad / b - decay * self.weights, (seen - pair) / b - decay * self.moves), strict=True):
                first += 0.1 * (g - first)
                second += 0.01 * (g * g - second)
                x += rate * first / (1 - 0.9**n) / (np.sqrt(second / (1 - 0.99**n)) + 1e-8)


# The labelled table's sentence frames. A name in braces is filled in; capital kinds are labelled, small ones are not.
FRAMES = [
    "please call {PHONE} before noon", "my phone is {PHONE} , thanks", "tel {PHONE}", "Phone: {PHONE}", "ring ( {word} ) {PHONE} or write", "{word} {PHONE} {word}", "{word} {word} {PHONE}",
    "reach me at {EMAIL}", "write to {EMAIL} today", "{word} {EMAIL} {word} {word}", "email: {EMAIL}", "contact {EMAIL} or {PHONE}", "{Word} {word} {MAIL} {word}", "mail {MAIL}", "{word} {IP} {word} {word}", "host {IP} answered",
    "{word} {CARD} {word}", "card {CARD}", "{word} {INTL} {word}", "call {INTL} now",
    "{Word} {word} {word} {digits} {word}", "order number {digits} of {date}", "{word} {word} {date} {word}", "version {version} of {word}", "page {small} of {small}", "at {time} on {date}", "{word} token = \" {hex} \" {word}", "{word} = {hex}",
    "cost $ {price} each", "{small} , {small} , {small} and {small}", "{word} at {word} dot {word} {word}", "the dot at the end of {word} {small}", "{Word} {word} . {Word} {word} , {word} {digits} .", "{word}### {long}$$$ {word}&&& {word}%%%", "{word} {long} {word}", "{word} {long} {long} {word}", "{year} - {year} {word}",
    "rows {small} - {small} : {small}", "{small} x {small} x {small}", "{word} {decimal} {word} {decimal}", "born {date} in {word}", "room {small} , {word} {year}", "{word} {small} {word} {small} {word} {small}", "isbn {isbn}", "{WORD}!! {digits}!! {WORD}!! {WORD}!!", "look at {word} . The dot {word} {word} .",
]


def labelled_rows(n: int = 660, seed: int = 3) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """The labelled table: (text, spans with kinds), from the frames above, filled by a seeded draw."""
    rng = np.random.default_rng(seed)
    num = lambda k: "".join(map(str, rng.integers(0, 10, k)))
    letters = lambda k: "".join(chr(97 + c) for c in rng.integers(0, 26, k))
    word = lambda: letters(rng.integers(2, 10))
    pick = lambda *x: x[rng.integers(len(x))]
    at, dot = (lambda: pick(" at ", " (at) ", " [at] ")), (lambda: pick(" dot ", " (dot) ", " [dot] "))
    fill = {
        "PHONE": lambda: pick(f"({num(3)}) {num(3)}-{num(4)}", f"{num(3)}-{num(3)}-{num(4)}", f"{num(3)}.{num(3)}.{num(4)}", f"({num(3)}) {num(3)} {num(4)}"),
        "EMAIL": lambda: (word() + pick("", "." + word(), num(2)) + at() + word() + dot() + pick("com", "net", "org", "edu")),
        "MAIL": lambda: f"{word()}.{word()}{num(2)}@{word()}{pick('', num(1))}.{pick('example.', '')}{pick('com', 'net', 'org')}",
        "IP": lambda: ".".join(str(x) for x in rng.integers(0, 256, 4)),
        "CARD": lambda: pick(" ", "-", "").join(num(4) for _ in range(4)),
        "INTL": lambda: pick(f"+1 ({num(3)}) {num(3)}-{num(4)}", f"+{num(2)} {num(3)} {num(4)} {num(3)}"),
        "word": word, "Word": lambda: word().title(), "WORD": lambda: word().upper(), "digits": lambda: num(rng.integers(1, 9)), "long": lambda: num(rng.integers(9, 20)), "small": lambda: str(rng.integers(0, 999)),
        "hex": lambda: "".join("0123456789abcdef"[c] for c in rng.integers(0, 16, 40)), "price": lambda: f"{num(2)}.{num(2)}", "decimal": lambda: f"{num(rng.integers(1, 5))}.{num(rng.integers(1, 5))}", "year": lambda: f"{rng.integers(1900, 2100)}",
        "date": lambda: pick(f"{num(4)}-{num(2)}-{num(2)}", f"{num(2)}/{num(2)}/{num(4)}", f"{num(2)}.{num(2)}.{num(4)}"), "time": lambda: f"{num(2)}:{num(2)}", "version": lambda: f"{num(1)}.{num(2)}.{num(1)}", "isbn": lambda: f"978-{num(1)}-{num(4)}-{num(4)}-{num(1)}",
    }
    kind = {"PHONE": "phone", "INTL": "phone", "EMAIL": "email", "MAIL": "email", "IP": "ip", "CARD": "card"}
    out = []
    for i in range(n):
        text, spans = "", []
        for j, part in enumerate(re.split(r"\{(\w+)\}", FRAMES[i % len(FRAMES)])):
            value = fill[part]() if j % 2 else part
            if j % 2 and part in kind:
                spans.append((len(text), len(text) + len(value), kind[part]))
            text += value
        out.append((text, spans))
    return out


def padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    t = max(1, *(len(r) for r in rows))
    ids, mask = np.full((len(rows), t, 5), N_FEATURES - 1), np.zeros((len(rows), t), bool)
    for i, r in enumerate(rows):
        ids[i, : len(r)], mask[i, : len(r)] = r, True
    return ids, mask


def train(rows=None) -> Field:
    """A field fitted to the labelled table."""
    rows = labelled_rows() if rows is None else rows
    feats, tags = [], []
    for text, spans in rows:
        ids, at = tokens(text, 0, len(text))
        tag = np.zeros(len(at), int)
        for s, e, kind in spans:
            inside = [i for i, (a, b) in enumerate(at) if a >= s and b <= e]
            tag[inside] = TAGS.index(f"I-{kind}")
            tag[inside[:1]] = TAGS.index(f"B-{kind}")
        feats.append(ids)
        tags.append(tag)
    ids, mask = padded(feats)
    gold = np.zeros(mask.shape, int)
    for i, tag in enumerate(tags):
        gold[i, : len(tag)] = tag
    field = Field()
    field.train(ids, mask, gold)
    return field


_SPELLED = re.compile(r"\bat\b.*\bdot\b|@", re.I | re.S)


#: Tokens of a range that are decoded at a time, tokens that two pieces of a range share, and tokens of a batch with its padding.
PIECE, SHARED, TOKENS = 1024, 128, 1 << 16


def cut(text: str, start: int, end: int):
    """A range's tokens in pieces that overlap: yields features, spans, and the places from which and up to which a span's beginning counts."""
    found = _TOKEN.finditer(text, start, end)
    spans, lead = [m.span() for m in islice(found, PIECE)], 0
    while spans:
        after = [m.span() for m in islice(found, PIECE - SHARED)]
        yield features(text, spans), spans, lead, len(spans) - (SHARED // 2 if after else 0)
        spans, lead = spans[-SHARED:] + after if after else [], SHARED // 2


def _batches(work: list):
    """Pieces of like length together, TOKENS tokens at most with the padding (one piece at least)."""
    work.sort(key=lambda w: len(w[2]))
    at = 0
    while at < len(work):
        n = at + 1
        while n < len(work) and (n + 1 - at) * len(work[n][2]) <= TOKENS:
            n += 1
        yield work[at:n]
        at = n


def decode(field: Field, texts: list[str], places: list[list[tuple[int, int]]]) -> list[list[tuple[int, int, int]]]:
    """(kind, start, end) that the field finds in each text's given ranges. A few batches of tokens are held at a time, however long texts and ranges are."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]

    def settle(work: list) -> None:
        for some in _batches(work):
            ids, mask = padded([w[1] for w in some])
            for (i, _, spans, first, last), tags in zip(some, field.viterbi(ids, mask), strict=True):
                tags = tags[: len(spans)]
                for j in np.flatnonzero(tags[first:last] % 2 == 1) + first:  # the odd ones begin a span
                    n = j + 1
                    while n < len(spans) and tags[n] == tags[j] + 1:
                        n += 1
                    out[i].append((int(tags[j] - 1) // 2, spans[j][0], spans[n - 1][1]))

    work, held = [], 0
    for i, ranges in enumerate(places):
        for s, e in ranges:
            for piece in cut(texts[i], s, e):
                work.append((i, *piece))
                held += len(piece[1])
                if held >= 4 * TOKENS:
                    settle(work)
                    work, held = [], 0
    settle(work)
    return out


def _sensible(kind: int, span: str) -> bool:
    """What a span must hold at least, whatever the field says."""
    if kind == 3:
        return 7 <= sum("0" <= c <= "9" for c in span) <= 15 and len(span) <= 40 and bool(re.search(r"[0-9][-. ()]+[0-9]", span))
    return kind == 0 and len(span) <= 120 and bool(_SPELLED.search(span))


def find(df: DataFrame, text: str = "text", field: Field | None = None) -> DataFrame:
    """Adds n_email, n_ip, n_card, n_phone (base spans), base (their list) and spans (base and the field's) to every row; lists are kind:start:end."""
    small_batches()
    field = field or train()
    names = [f"n_{k}" for k in KINDS]
    schema = ", ".join(f"{n} long" for n in names) + ", base string, spans string"

    @F.arrow_udf(schema)
    def spans_of(col: pa.Array) -> pa.Array:
        texts = [t or "" for t in col.to_pylist()]
        places = [neighbourhoods(t) for t in texts]
        base = [base_spans(t) if p else [[], [], [], []] for t, p in zip(texts, places, strict=True)]
        more = decode(field, texts, places)
        say = lambda found: ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(found))
        plain, full = [], []
        for t, b, extra in zip(texts, base, more, strict=True):
            known = [(k, s, e) for k in range(4) for s, e in b[k]]
            taken = sorted((s, e) for _, s, e in known)
            starts, ends = np.array([s for s, _ in taken], int), np.maximum.accumulate(np.array([e for _, e in taken] or [0], int))
            new = []
            for k, s, e in set(extra):
                before = int(np.searchsorted(starts, e))  # base spans that begin before this one ends
                if _sensible(k, t[s:e]) and not (before and ends[before - 1] > s):
                    new.append((k, s, e))
            plain.append(say(known))
            full.append(say(known + new))
        counts = [pa.array([len(b[k]) for b in base], pa.int64()) for k in range(4)]
        return pa.StructArray.from_arrays([*counts, pa.array(plain, pa.string()), pa.array(full, pa.string())], [*names, "base", "spans"])

    own = without(df, *names, "base", "spans")
    return own.select("*", spans_of(F.col(text)).alias("pii_found")).select(*[f"`{c}`" for c in own.columns], "pii_found.*")


def masks(text: Column) -> Column:
    """Edits that put <KIND> in place of the base spans: array<struct<start, end, text>>, in order; of spans that overlap the first stays."""

    @F.arrow_udf("array<struct<start: int, end: int, text: string>>")
    def edits(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts.to_pylist():
            found, done = [], 0
            for s, e, k in sorted((s, e, k) for k, spans in enumerate(base_spans(t or "")) for s, e in spans):
                if s >= done:
                    found.append({"start": s, "end": e, "text": f"<{KINDS[k].upper()}>"})
                    done = e
            out.append(found)
        return pa.array(out, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("text", pa.string())])))

    return edits(text)
