"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes that finds more."""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quillspark.llm.common import steps, table, utf8
from quillspark.llm.features import LOWER, runs, spans_hash

KINDS = ("email", "ip", "card", "phone", "account", "iban", "ssn", "person")

# Each match of these begins where the fixed pattern's leftmost match begins; possessive runs keep very long texts linear.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Words that tell what stands near them, by class.
CUES = {
    "phone": "call dial phone tel telephone mobile cell fax whatsapp sms ring reach telefon rufnummer handy anrufen téléphone appelez portable teléfono móvil llame",
    "account": "account acct card credit debit iban konto kontonummer karte compte carte cuenta tarjeta paid pay charge bank",
    "count": "isbn issn version section chapter page pages rows row columns total count units timestamp epoch time order id ids no number pi ratio year figure table lines bytes seconds sold code build seed",
    "person": "mr mrs ms dr prof herr frau señor señora monsieur madame dear name named",
    "ssn": "ssn social security",
}
#: The small labelled table: [KIND words] marks personal data, {VALUE} is drawn anew for each of the table's copies of a line.
LABELLED = """
Write to [EMAIL {mail}] before noon
please ask [EMAIL {mail}] or [EMAIL {mail}] about it.
her address is [EMAIL {mail}], and the
mail: [EMAIL {mail}]; web site below
The host [IP {ip}] did not answer
from [IP {ip}] to [IP {ip}] again
und [IP {ip}] den beim
server [IP {ip6}] is down, use [IP {ip6}] now
call [PHONE {intl}] on Monday
or dial [PHONE {intl}] for help.
is [PHONE {intl}] in that
phone: [PHONE {intl}] mobile [PHONE {intl}] thanks
la [PHONE {intl}] por la
numéro [PHONE {intl}] merci
call [PHONE {local}] today
phone: [PHONE {local}] or fax [PHONE {local}] instead
Telefon [PHONE {local}] bis acht
mon téléphone [PHONE {local}] est là
tel. [PHONE {local}], second floor
paid with [ACCOUNT {card}] yesterday
card [ACCOUNT {card}] expires soon
the [ACCOUNT {card}] and [ACCOUNT {card}] were
By [ACCOUNT {card}] it and.
de [ACCOUNT {card}] que
use [ACCOUNT {card}] to pay
account [ACCOUNT {short}] the
bank account no [ACCOUNT {short}] is closed
Konto [ACCOUNT {short}] wird
transfer to [IBAN {iban}] by Friday
IBAN: [IBAN {iban}] thanks
auf das Konto [IBAN {iban}] und
her SSN is [SSN {ssn}] as filed
SSN [SSN {ssn}] on file
social security number [SSN {ssn}] was
Dear Mr [PERSON {person}], thank you
my name is [PERSON {person}] and
His name is [PERSON {person}].
met Dr. [PERSON {person}] at noon
Frau [PERSON {person}] kommt heute
monsieur [PERSON {person}] est là
ISBN {isbn} is out of print
the book (ISBN {isbn}) was read
pi is {decimal} or so
a mean of {decimal} and a ratio of {decimal} here
{stamp} rows were read at {stamp} today
timestamp {stamp} in the log
a total of {big} rows and {few} columns
we have {big} bytes in {few} files
order no. {few} from {few} March, id {big} again
In {year} we sold {few} units at {price} each
chapter {few}.{few} of version {few}.{few}.{few} was read on {date} again
The year {year} and the {few} days after it
between {date} and {date} they met
at {few}:{few} or {few}:{few} we met {few} times
see section {few}.{few}.{few} and page {few} of {few}
token = "{hex}" was seen
password: hunter{few} is set in file config.v{few}.json
C++ and A+ are fine (see note {few}) or (not)
it was paid. In {year} we sold {few} units
the card had {few} points in {year} and paid {few} euros
Licensed under the Apache License, Version {few}.0.
Licensed under CC BY-NC {few}.0.
the ratio {few}:{few} (or {price}) of x={few} and y=-{few}
{word}*** {word}### {word}%%% {word}$$$ {word}&&& {word}
{loud}!! {loud}!! {loud}!! {loud}.!!
{word} | {word}, | {word}. | {word} | {word}
{cap} {word} {word} {word}, {word} {word}. {cap} {word} {word}
{word} {word} {cap} {word} of {cap}
{cap}. {cap}. {cap} {word} of {word}. {cap}.
{word} {word} of. {cap}. {cap}. {word} {cap}
{word}, {cap}. {cap} {word}. {cap} {cap}, {word}
the name of the {word} is {word} and
call the {word} {few} times, then pay {price} more
Elle est là, où il était déjà été.
El niño comió en la mañana.
""".strip().split("\n")
DRAWS = 4  # copies of each line in the table

LABELS = ("O", "EMAIL", "IP", "ACCOUNT", "ACCOUNT+", "PHONE", "PHONE+", "IBAN", "IBAN+", "SSN", "PERSON", "PERSON+")
_KIND = {"EMAIL": "email", "IP": "ip", "ACCOUNT": "account", "PHONE": "phone", "IBAN": "iban", "SSN": "ssn", "PERSON": "person"}
DIGITS = {"account": 8, "phone": 7, "iban": 10, "ssn": 9}  # of a chain's span, at least
CONFIDENT = 2.2  # log odds of a span against none, from which mask() replaces it: nine to one
PII_BYTES = 1 << 19  # of text in a numpy step: a token has a number for each label and pair of labels


def _values(draw: random.Random) -> dict:
    """What a line's {VALUE} may become."""
    d = lambda n: "".join(draw.choice("0123456789") for _ in range(n))
    word = lambda: "".join(draw.choice("aeiourstnlhd") for _ in range(draw.randint(2, 9)))
    hexes = lambda n: "".join(draw.choice("0123456789abcdef") for _ in range(n))
    sep = draw.choice("- .")
    names = ("Anna", "Pierre", "Jürgen", "María", "Olga", "Tariq", "Ines", "Bruno"), ("Keller", "Dupont", "Novak", "García", "Smith", "Haddad", "Rossi", "Lund")
    return {
        "mail": lambda: draw.choice((f"{word()}.{word()}@{word()}.org", f"{word()}{d(2)}@{word()}.{word()}.com", f"{word()}_{word()}+{word()}@{word()}-{word()}.net")),
        "ip": lambda: ".".join(str(draw.randint(1, 255)) for _ in range(4)),
        "ip6": lambda: draw.choice((":".join(hexes(4) for _ in range(8)), f"2001:db8::{hexes(4)}:{hexes(3)}", f"fe80::{hexes(4)}:{hexes(4)}:{hexes(4)}")),
        "intl": lambda: draw.choice((f"+1 ({d(3)}) {d(3)}-{d(4)}", f"+49 {d(2)} {d(7)}", f"+33 1 {d(2)} {d(2)} {d(2)} {d(2)}", f"+44{d(10)}", f"+34 {d(3)}-{d(3)}-{d(3)}", f"+1-{d(3)}-{d(3)}-{d(4)}")),
        "local": lambda: draw.choice((f"0{d(2)} {d(4)} {d(4)}", f"(0{d(2)}) {d(7)}", f"{d(3)}-{d(3)}-{d(4)}", f"0{d(3)} {d(6)}", f"0{d(1)} {d(2)} {d(2)} {d(2)} {d(2)}")),
        "card": lambda: draw.choice((d(16), d(16), f"{d(4)} {d(4)} {d(4)} {d(4)}", f"{d(4)}-{d(4)}-{d(4)}-{d(4)}", d(15))),
        "short": lambda: d(draw.randint(8, 12)),
        "iban": lambda: draw.choice((f"DE{d(2)} {d(4)} {d(4)} {d(4)} {d(4)} {d(2)}", f"FR{d(2)}{d(22)}", f"GB{d(2)}ABCD{d(14)}", f"ES{d(2)} {d(4)} {d(4)} {d(4)} {d(4)} {d(4)}")),
        "ssn": lambda: f"{d(3)}-{d(2)}-{d(4)}",
        "person": lambda: draw.choice(names[0]) + " " + draw.choice(names[1]) if draw.random() < 0.6 else draw.choice(names[1]),
        "isbn": lambda: draw.choice((f"978{d(10)}", f"978-{d(1)}-{d(3)}-{d(5)}-{d(1)}")),
        "decimal": lambda: f"{d(1)}.{d(draw.randint(6, 16))}",
        "stamp": lambda: f"1{d(draw.choice((9, 12)))}",
        "big": lambda: d(draw.choice((7, 10, 13, 14))),
        "few": lambda: str(draw.randint(1, 99)),
        "year": lambda: str(draw.randint(1900, 2030)),
        "price": lambda: f"{draw.randint(1, 999)}.{d(2)}",
        "date": lambda: sep.join((d(2), d(2), str(draw.randint(1990, 2030)))) if sep != " " else f"{draw.randint(1990, 2030)}-{d(2)}-{d(2)}",
        "hex": lambda: hexes(40),
        "word": word, "loud": lambda: word().upper(), "cap": lambda: word().capitalize(),
    }


def labelled_table(seed: int = 1, draws: int = DRAWS) -> list[str]:
    """The marked lines with values filled in, so many copies of each; another seed gives another table."""
    draw = random.Random(seed)
    values = _values(draw)
    return [re.sub(r"\{(\w+)\}", lambda m: values[m[1]](), line) for line in LABELLED for _ in range(draws)]


# word shapes: flags of the characters in a token
_FLAG = np.zeros(256, np.uint16)
for _i, _set in enumerate((range(65, 91), range(97, 123), range(48, 58), b"@", b".", b"-", b"+", b"()", b"\"'=:", b",;!?", b"/_%#&*$|", range(128, 256))):
    _FLAG[list(_set)] = 1 << _i
_CLASS = np.zeros(256, np.int8)
for _i in range(12):
    _CLASS[_FLAG >> _i & 1 == 1] = _i + 1
_LENGTH = np.searchsorted([2, 3, 4, 6, 9, 13, 16, 20], np.arange(64), "right").astype(np.int16)
_DIGITS = np.searchsorted([1, 3, 4, 5, 8, 10, 11, 13, 14, 15, 16, 17, 20], np.arange(64), "right").astype(np.int16)
_ROUGH = np.searchsorted([1, 2, 3, 5, 9], np.arange(64), "right").astype(np.int16)
_SIZES = (4096, 13, 13, 9, 14, 5, 5, 4, 6, 6, 6, 36, 36)  # values of each feature
_AT = np.concatenate([[0], np.cumsum(_SIZES)])
_TRIM = np.zeros(256, bool)
_TRIM[list(b".,:;!?)(\"'#")] = True


def _cue_table() -> tuple[np.ndarray, np.ndarray]:
    words = [(w, i + 1) for i, ws in enumerate(CUES.values()) for w in ws.split()]
    data = np.frombuffer(" ".join(w for w, _ in words).encode(), np.uint8)
    starts, ends, _ = runs(data != 32, np.array([0, len(data)]))
    h = spans_hash(data, starts, ends)
    order = np.argsort(h)
    return h[order], np.array([c for _, c in words])[order]


_CUE_HASH, _CUE_CLASS = _cue_table()


def cues(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The class of each token, case and a sign at either end apart, in CUES; 0 for others."""
    a, b = starts + (_TRIM[data[starts]] & (ends - starts > 1)), ends
    b = b - (_TRIM[data[b - 1]] & (b - a > 1))
    h = spans_hash(LOWER[data], a, b)
    at = np.minimum(np.searchsorted(_CUE_HASH, h), len(_CUE_HASH) - 1)
    return np.where(_CUE_HASH[at] == h, _CUE_CLASS[at], 0)


def shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, line: np.ndarray) -> np.ndarray:
    """The features of each token, as rows of indices into one weight table: its word shape, and cues and rough shapes of its neighbours in the line."""
    if not len(starts):
        return np.zeros((0, len(_SIZES)), np.int64)
    flags = np.bitwise_or.reduceat(_FLAG[data], np.stack([starts, ends], 1).ravel().clip(max=len(data) - 1))[::2] if len(data) else np.zeros(0, np.uint16)
    running = lambda mask: np.concatenate([[0], np.cumsum(mask, dtype=np.int32)])
    count = lambda mask: (c := running(mask))[ends] - c[starts]
    digits = count((data >= 48) & (data <= 57))
    cue = cues(data, starts, ends)
    # at rough: digits, and whether letters are there
    rough = _ROUGH[np.minimum(digits, 63)] * 6 + np.minimum((flags & 3 > 0) + 2 * (flags & 32 > 0) + (flags & 64 > 0), 5)

    def near(value: np.ndarray, by: int) -> np.ndarray:
        out = np.zeros(len(value), value.dtype)
        if len(value) > abs(by):
            here, there = (slice(by, None), slice(None, -by)) if by > 0 else (slice(None, by), slice(-by, None))
            out[here] = np.where(line[here] == line[there], value[there], 0)
        return out

    cols = (
        flags & 4095, _CLASS[data[starts]], _CLASS[data[ends - 1]], _LENGTH[np.minimum(ends - starts, 63)], _DIGITS[np.minimum(digits, 63)], np.minimum(count(data == 46), 4), np.minimum(count(data == 45), 4), np.minimum(count(data == 58), 3),
        near(cue, 1), near(cue, 2), near(cue, -1), near(rough, 1), near(rough, -1),
    )
    return np.stack([c.astype(np.int64) + at for c, at in zip(cols, _AT, strict=False)], 1)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs without ASCII white space, and the text each is in."""
    return runs(~((data == 32) | ((data >= 9) & (data <= 13))), offsets)


class Crf:
    """Weights of shapes by label, and of label pairs. Tokens of a line form a chain that begins and ends at label O."""

    def __init__(self, emit: np.ndarray, move: np.ndarray) -> None:
        self.emit, self.move = emit.astype(np.float32), move.astype(np.float32)
        # a token whose lead for O is above what any neighbours can add is O in every best chain
        self.lead = float(2 * (move.max() - move.min()))

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Of tokens with features x, by label."""
        score = self.emit[x[:, 0]].copy()
        for i in range(1, x.shape[1]):
            score += self.emit[x[:, i]]
        return score

    def odds(self, score: np.ndarray, label: np.ndarray, line: np.ndarray, a: int, b: int) -> float:
        """Log odds of the labels of tokens a to b - 1 against O for all of them, the rest of the chain as it is."""
        before = label[a - 1] if a and line[a - 1] == line[a] else 0
        after = label[b] if b < len(label) and line[b] == line[a] else 0
        path = [before, *label[a:b].tolist(), after]
        gain = sum(float(score[i, label[i]] - score[i, 0]) for i in range(a, b))
        gain += sum(float(self.move[x, y]) for x, y in zip(path, path[1:], strict=False))
        return gain - float(self.move[before, 0] + self.move[0, 0] * (b - a - 1) + self.move[0, after])

    def decode(self, score: np.ndarray, line: np.ndarray) -> np.ndarray:
        """The best labels of tokens with these scores, a line's tokens together, by Viterbi.

        Tokens that are O whatever their neighbours cut lines into stretches, which are decoded in
        lockstep; the result is that of whole lines.
        """
        out = np.zeros(len(score), np.int8)
        open_ = score[:, 0] - score[:, 1:].max(1) <= self.lead
        at = np.flatnonzero(open_)
        if not len(at):
            return out
        first = np.flatnonzero(np.diff(at, prepend=-9) != 1)
        first = np.unique(np.concatenate([first, np.flatnonzero(np.diff(line[at], prepend=-1) != 0)]))
        size = np.diff(np.append(first, len(at)))
        order = np.argsort(-size, kind="stable")
        begin, size = at[first[order]], size[order]
        best = self.move[0] + score[begin]
        back: list[np.ndarray] = []
        final = best + self.move[:, 0]
        for t in range(1, int(size[0])):
            m = int(np.searchsorted(-size, -t, "left"))
            path = best[:m, :, None] + self.move
            back.append(path.argmax(1).astype(np.int8))
            best = np.take_along_axis(path, back[-1][:, None].astype(np.int64), 1)[:, 0] + score[begin[:m] + t]
            final[:m] = best + self.move[:, 0]
        label = final.argmax(1).astype(np.int8)
        for t in range(int(size[0]) - 1, -1, -1):
            m = int(np.searchsorted(-size, -t, "left"))
            out[begin[:m] + t] = label[:m]
            if t:
                label[:m] = back[t - 1][np.arange(m), label[:m]]
        return out


def parse(lines: list[str] | tuple[str, ...]) -> tuple[list[list[str]], list[list[int]]]:
    """Tokens and labels of marked lines."""
    texts, marks = [], []
    for row in lines:
        text, label = [], []
        for part in re.split(r"(\[[A-Z]+ [^\]]*\])", row):
            m = re.fullmatch(r"\[([A-Z]+) ([^\]]*)\]", part)
            if m:
                words = m[2].split()
                label += [m[1], *[m[1] + "+"] * (len(words) - 1)]
                text += words
            else:
                words = part.split()
                if words and text and not part[0].isspace():  # a point right after a mark belongs to its token
                    text[-1] += words.pop(0)
                label += ["O"] * len(words)
                text += words
        texts.append(text)
        marks.append([LABELS.index(x) for x in label])
    return texts, marks


@lru_cache(1)
def train(lines: tuple[str, ...] | None = None, rounds: int = 150) -> Crf:
    """Fits the field to marked lines (those of labelled_table): gradient of the log likelihood by forward and backward sums over all lines at once."""
    texts, marks = parse(lines or labelled_table())
    n, most, k = len(texts), max(map(len, texts)), len(LABELS)
    raw = "\n".join(" ".join(t) for t in texts).encode()
    data = np.frombuffer(raw, np.uint8)
    starts, ends, _ = tokens(data, np.array([0, len(data)]))
    flat = shapes(data, starts, ends, np.repeat(np.arange(n), [len(t) for t in texts]))
    x, y, on = np.zeros((n, most, flat.shape[1]), np.int64), np.zeros((n, most), np.int64), np.zeros((n, most), bool)
    at = 0
    for i, (t, m) in enumerate(zip(texts, marks, strict=True)):
        x[i, : len(t)], y[i, : len(t)], on[i, : len(t)] = flat[at : at + len(t)], m, True
        at += len(t)
    emit, move = np.zeros((int(_AT[-1]), k)), np.zeros((k, k))
    size = on.sum(1)
    state = [np.zeros_like(emit), np.zeros_like(move), np.zeros_like(emit), np.zeros_like(move)]
    hot = np.eye(k)
    # the weight that each feature of each token is, in order, so that gradients are sums of runs
    used = x[on]
    order = np.argsort(used, axis=None, kind="stable")
    cells, runs_at = np.unique(used.ravel()[order], return_index=True)
    of = order // used.shape[1]
    for step in range(1, rounds + 1):
        score = emit[x].sum(2)
        lse = lambda a, axis: (m := a.max(axis, keepdims=True)).squeeze(axis) + np.log(np.exp(a - m).sum(axis))
        ahead = np.zeros((n, most, k))
        ahead[:, 0] = move[0] + score[:, 0]
        for t in range(1, most):
            ahead[:, t] = np.where(on[:, t, None], lse(ahead[:, t - 1, :, None] + move, 1) + score[:, t], ahead[:, t - 1])
        total = lse(ahead[:, -1] + move[:, 0], 1)
        behind = np.zeros((n, most, k))
        for t in range(most - 1, -1, -1):
            nxt = lse(move + (score[:, t + 1] + behind[:, t + 1])[:, None, :], 2) if t + 1 < most else None
            last = (size == t + 1)[:, None]
            behind[:, t] = np.where(last, move[:, 0], nxt if nxt is not None else 0)
        p = np.exp(ahead + behind - total[:, None, None]) * on[:, :, None]
        g_emit, g_move = np.zeros_like(emit), np.zeros_like(move)
        want = hot[y] * on[:, :, None]
        g_emit[cells] = np.add.reduceat((want - p)[on][of], runs_at)
        g_move[0] += (want[:, 0] - p[:, 0]).sum(0)
        for t in range(1, most):
            pair = np.exp(ahead[:, t - 1, :, None] + move + (score[:, t] + behind[:, t])[:, None, :] - total[:, None, None]) * on[:, t, None, None]
            g_move += (hot[y[:, t - 1]][:, :, None] * want[:, t][:, None, :] - pair).sum(0)
        rows = np.arange(n)
        g_move[:, 0] += (hot[y[rows, size - 1]] - p[rows, size - 1]).sum(0)
        for i, (w, g) in enumerate(((emit, g_emit), (move, g_move))):
            g = g / n - 2e-3 * w
            state[i] = 0.9 * state[i] + 0.1 * g
            state[i + 2] = 0.99 * state[i + 2] + 0.01 * g * g
            w += 0.15 * (state[i] / (1 - 0.9**step)) / (np.sqrt(state[i + 2] / (1 - 0.99**step)) + 1e-6)
    return Crf(emit, move)


def _luhn(digits: str) -> bool:
    twice = [2 * int(d) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 * (d > 9) for d in twice)) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The fixed patterns' spans, by kind and then start, in code points."""
    out = []
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            out.append(("email", start, end))
        else:
            end = max(end, at)  # a failed run is not looked at again
        at = text.find("@", max(at + 1, end))
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= sum(map(str.isdigit, m[0])) <= 15]
    return out


def find_spans(data: np.ndarray, offsets: np.ndarray, crf: Crf, least: float | None = None) -> list[tuple[list, list]]:
    """For each text: the fixed patterns' spans, and all spans, both by kind and then start, in code points.

    A chain's span is added where it overlaps no span of the patterns, and where its log odds are
    least or more, if that is given.
    """
    n = len(offsets) - 1
    out: list[tuple[list, list]] = [([], [])] * n
    digit = (data >= 48) & (data <= 57)
    sign = np.concatenate([[0], np.cumsum(digit | (data == 64))])
    some = np.flatnonzero(sign[offsets[1:]] > sign[offsets[:-1]])
    starts, ends, owner = tokens(data, offsets)
    extra: dict[int, list[tuple[str, int, int]]] = {}
    if len(starts):
        newline = np.concatenate([[0], np.cumsum(data == 10)])
        line = newline[starts] + owner
        score = crf.scores(shapes(data, starts, ends, line))
        label = crf.decode(score, line)
        for i in np.flatnonzero(label):
            kind = LABELS[label[i]]
            spans = extra.setdefault(int(owner[i]), [])
            kin = kind.endswith("+") and spans and spans[-1][3] == i - 1 and spans[-1][0] == _KIND[kind[:-1]] and line[i] == line[i - 1]
            if kin:
                spans[-1] = (spans[-1][0], spans[-1][1], int(ends[i]), int(i), spans[-1][4])
            elif not kind.endswith("+"):  # a chain's later part without its beginning is no span
                spans.append((_KIND[kind], int(starts[i]), int(ends[i]), int(i), int(i)))
        if least is not None:
            extra = {k: [x for x in spans if crf.odds(score, label, line, x[4], x[3] + 1) >= least] for k, spans in extra.items()}
    for i in sorted({*some.tolist(), *extra}):
        lo = int(offsets[i])
        raw = data[lo : offsets[i + 1]].tobytes()
        text = raw.decode()
        base = base_spans(text)
        more = []
        for kind, a, b, *_ in extra.get(i, ()):
            part = raw[a - lo : b - lo].decode()
            start = len(raw[: a - lo].decode())
            left = len(part) - len(part.lstrip("\"'(<[.,;:!?*#%$&|" if kind != "phone" else "\"'<[.,;:!?*#%$&|"))
            size = len(part.rstrip("\"')>].,;:!?*#%$&|"))
            span = (kind, start + left, start + size)
            if size > left and sum(c.isdigit() for c in part) >= DIGITS.get(kind, 0) and not any(x < span[2] and span[1] < y for _, x, y in base):
                more.append(span)
        out[i] = (base, sorted(base + more, key=lambda s: (KINDS.index(s[0]), s[1])))
    return out


def joined(spans: list) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def detect(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans for each row of (doc_id, text).

    Counts and the digest are of the fixed patterns; spans holds those of the random field too.
    A null text counts as empty; repeated rows repeat; an empty table gives an empty table; other
    columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in steps(offsets, PII_BYTES):
                found = find_spans(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], shared.value)
                counts = [pa.array([sum(s[0] == kind for s in base) for base, _ in found], pa.int64()) for kind in KINDS[:4]]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *counts, pa.array([hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found]), pa.array([joined(every) for _, every in found])], names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string")


def redact(text: str, spans: list) -> str:
    """The text with each span as <KIND>; overlapping spans as one, named after the first."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def mask(docs: DataFrame, least: float = CONFIDENT) -> DataFrame:
    """docs with personal data in text replaced by its kind, and n_chars, where there is such a column, set to the new length.

    Replaced are the fixed patterns' spans and those of the field with log odds of least or more.
    Null texts stay null, empty ones empty; repeated rows repeat; an empty table gives an empty
    table; further columns pass through as they are, whatever their names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train())
    columns = docs.columns
    at, size_at = columns.index("text"), columns.index("n_chars") if "n_chars" in columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(at))
            for a, b in steps(offsets, PII_BYTES):
                part = batch.slice(a, b - a)
                found = find_spans(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], shared.value, least)
                hit = [i for i, (_, every) in enumerate(found) if every]
                if hit:
                    texts = part.column(at).to_pylist()
                    for i in hit:
                        texts[i] = redact(texts[i], found[i][1])
                    cols = list(part.columns)
                    cols[at] = pa.array(texts, cols[at].type)
                    if size_at is not None:
                        sizes = cols[size_at].to_pylist()
                        for i in hit:
                            sizes[i] = len(texts[i])
                        cols[size_at] = pa.array(sizes, cols[size_at].type)
                    part = pa.RecordBatch.from_arrays(cols, names=columns)
                yield part

    return docs.mapInArrow(run, docs.schema)


def op5_pii(spark, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return detect(table(spark, sf_dir, "documents").select("doc_id", "text"))
