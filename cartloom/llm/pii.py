"""Personal data: fixed patterns, and a character BiLSTM-CRF that adds what the patterns miss.

The patterns give the base spans of each kind. The model is a character-level bidirectional LSTM
with a CRF on top, trained in numpy on labelled spans: windows around base spans of a bounded
sample of texts, and made-up spans of every kind set into texts of that sample, alone and several
in a row. A pattern that swallows its neighbour fails; the model tells the two apart. Half of the
made-up spans are in spellings that no pattern knows: ``ann [at] host [dot] org``, ``10[.]0[.]0[.]1``,
card groups with other gaps, phones without a plus such as ``(269) 555-3296``. Numbers of other
kinds (dates, book numbers, sums, references) are set in without a label.

Every span holds a digit, ``@`` or a bracketed "at", so the model reads the text within ``reach``
characters of one, in overlapping windows: the number of windows grows with such text, without a
cap. Each window is decoded by Viterbi; the spans of all windows of a text are then reconciled
globally, as the set without overlaps that has the highest total margin over no span. What remains
must not touch a base span, and either pass the exact checks of base spans (digits, Luhn, parts) or
have a margin of ``LOOSE_MARGIN`` and pass a looser check of its kind: the number of digits and
groups, Luhn, or the address after brackets and words are read as signs. Addresses
spelled in words alone ("ann at host dot org") are left.

Edge cases: a null text is empty and has no spans; an empty table gives no rows; texts of any
length are read whole, window by window; repeated rows are searched one by one; an empty sample
still trains on made-up spans; further columns of any name are kept in ``row`` only. Offsets count
code points, ends are exclusive.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.llm.tables import bounded_sample, returning_memory

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # kind, start, end

# Base patterns, written so that each text is read in linear time.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*+\Z")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANCHOR = re.compile(r"[0-9@]|[\[({<] ?at ?[\])}>]", re.IGNORECASE)
_NOT_DIGIT = re.compile(r"[^0-9]+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def valid(kind: int, found: str) -> bool:
    if kind == 0:
        local, _, domain = found.partition("@")
        return bool(local) and _LOCAL_CHARS.issuperset(local) and _DOMAIN.fullmatch(domain) is not None
    if kind == 1:
        parts = found.split(".")
        return len(parts) == 4 and all(
            p.isascii() and p.isdigit() and len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts
        )
    digits = _NOT_DIGIT.sub("", found)
    if kind == 2:
        return 13 <= len(digits) <= 19 and _CARD.fullmatch(found) is not None and luhn(digits)
    return 9 <= len(digits) <= 15 and _PHONE.fullmatch(found) is not None


# Looser checks, for spans of the model only.
_SPELLED_AT = re.compile(r" ?[\[({<] ?(?:at|@) ?[\])}>] ?", re.IGNORECASE)
_SPELLED_DOT = re.compile(r" ?[\[({<] ?(?:dot|\.) ?[\])}>] ?", re.IGNORECASE)
_LOOSE_CARD = re.compile(r"[0-9](?:[\x20\xA0./_-]{0,3}[0-9])+")
_LOOSE_PHONE = re.compile(r"\(?[0-9]+(?:[\x20\xA0()./-]{1,3}[0-9]+){1,4}")
_NUMBER_BEFORE = re.compile(r"[0-9][.:/,_-]?\Z")
_NUMBER_AFTER = re.compile(r"[.:/,_-]?[0-9]")

#: Least margin over no span, in nats, of a span that passes only the looser check.
LOOSE_MARGIN = 0.5


def loosely_valid(kind: int, found: str) -> bool:
    """Whether ``found`` is a value of its kind in another spelling."""
    if kind < 2:
        plain = _SPELLED_DOT.sub(".", _SPELLED_AT.sub("@", found))
        return valid(kind, plain) and (kind == 1 or plain.rpartition(".")[2].isalpha())
    digits = _NOT_DIGIT.sub("", found)
    if kind == 2:
        return 13 <= len(digits) <= 19 and _LOOSE_CARD.fullmatch(found) is not None and luhn(digits)
    uneven = len({len(g) for g in _NOT_DIGIT.split(found) if g}) > 1  # not a run of years or of thousands
    return 9 <= len(digits) <= 15 and uneven and _LOOSE_PHONE.fullmatch(found) is not None and found.count("(") == found.count(")")


def base_spans(text: str) -> list[Span]:
    """Leftmost matches of each kind that do not overlap, less those that fail the check."""
    spans = []
    at, done = text.find("@"), 0
    while at >= 0:
        match = _DOMAIN.match(text, at + 1)
        start = at
        if match:
            while start > done and text[start - 1] in _LOCAL_CHARS:
                start -= 1
        if match and start < at:
            spans.append((0, start, match.end()))
            done = match.end()
        at = text.find("@", max(at + 1, done))
    for kind, pattern in ((1, _IP), (2, _CARD)):
        spans += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if valid(kind, m.group())]
    if "+" in text:
        spans += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if valid(3, m.group())]
    return spans


# Characters as classes.

_CLASSES = {c: i for i, c in enumerate("0@.-_%+() \n,:;/[]", 2)}
_TABLE = np.full(128, 1, np.int8)  # any other sign
for _c, _i in _CLASSES.items():
    _TABLE[ord(_c)] = _i
_TABLE[ord("0") : ord("9") + 1] = _CLASSES["0"]
for _c in "{<":
    _TABLE[ord(_c)] = _CLASSES["["]
for _c in "}>":
    _TABLE[ord(_c)] = _CLASSES["]"]
LETTER, OTHER = len(_CLASSES) + 2, len(_CLASSES) + 3
_TABLE[ord("a") : ord("z") + 1] = _TABLE[ord("A") : ord("Z") + 1] = LETTER
N_CLASSES = OTHER + 1  # class 0 pads


def classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 128, _TABLE[np.minimum(points, 127)], OTHER).astype(np.int8)


# The model. Tags: 0 none, 1 + 2k begins a span of kind k, 2 + 2k goes on.

N_TAGS = 1 + 2 * len(KINDS)
_ALLOWED = np.ones((N_TAGS, N_TAGS), bool)
for _k in range(len(KINDS)):
    _ALLOWED[:, 2 + 2 * _k] = False
    _ALLOWED[[1 + 2 * _k, 2 + 2 * _k], 2 + 2 * _k] = True
_START = np.array([t == 0 or t % 2 == 1 for t in range(N_TAGS)])
FORBIDDEN = np.float32(-1e4)


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Tagger:
    """Parameters of the network: input table and recurrence of both directions; output; transitions."""

    params: dict[str, np.ndarray]

    @staticmethod
    def fresh(hidden: int, seed: int) -> Tagger:
        r = np.random.default_rng(seed)
        p = {"in": r.normal(0, 0.3, (2, N_CLASSES, 4 * hidden)).astype(np.float32)}
        p["in"][:, :, hidden : 2 * hidden] += 1  # forget gates start open
        p["rec"] = r.normal(0, 1 / np.sqrt(hidden), (2, hidden, 4 * hidden)).astype(np.float32)
        p["out"] = r.normal(0, 0.3, (2 * hidden, N_TAGS)).astype(np.float32)
        p["bias"] = np.zeros(N_TAGS, np.float32)
        p["move"] = np.zeros((N_TAGS, N_TAGS), np.float32)
        return Tagger(p)

    def _pass(self, x: np.ndarray, keep: bool):
        """Hidden states (direction, time, batch, hidden); what back-propagation needs if asked.

        The second direction reads the windows from their ends, so its time runs backwards.
        """
        table, rec = self.params["in"], self.params["rec"]
        n, (steps, batch) = rec.shape[1], x.shape
        given = np.stack([table[0][x], table[1][x[::-1]]])
        out = np.empty((2, steps, batch, n), np.float32)
        h, c, trace = np.zeros((2, batch, n), np.float32), np.zeros((2, batch, n), np.float32), []
        for t in range(steps):
            z = given[:, t] + h @ rec
            gate = _sigmoid(z[..., : 3 * n])
            new = np.tanh(z[..., 3 * n :])
            before = c
            c = gate[..., n : 2 * n] * c + gate[..., :n] * new
            tc = np.tanh(c)
            h = gate[..., 2 * n :] * tc
            out[:, t] = h
            if keep:
                trace.append((gate, new, before, tc))
        return out, trace

    def emissions(self, x: np.ndarray) -> np.ndarray:
        """(time, batch, tags) for classes (time, batch)."""
        out, _ = self._pass(x, False)
        return np.concatenate([out[0], out[1][::-1]], axis=2) @ self.params["out"] + self.params["bias"]

    def moves(self) -> np.ndarray:
        return np.where(_ALLOWED, self.params["move"], FORBIDDEN)

    def step(self, x: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood of a batch, and gradients."""
        steps, batch = x.shape
        out, trace = self._pass(x, True)
        both = np.concatenate([out[0], out[1][::-1]], axis=2)
        e = both @ self.params["out"] + self.params["bias"]
        n, weight = self.params["rec"].shape[1], np.exp(self.moves())  # 0 where forbidden
        tiny = np.float32(1e-30)
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[0] = np.where(_START, e[0], FORBIDDEN)
        for t in range(1, steps):
            top = alpha[t - 1].max(axis=1, keepdims=True)
            alpha[t] = top + np.log(np.exp(alpha[t - 1] - top) @ weight + tiny) + e[t]
        for t in range(steps - 2, -1, -1):
            s = e[t + 1] + beta[t + 1]
            top = s.max(axis=1, keepdims=True)
            beta[t] = top + np.log(np.exp(s - top) @ weight.T + tiny)
        top = alpha[-1].max(axis=1)
        total = top + np.log(np.exp(alpha[-1] - top[:, None]).sum(axis=1))
        gold = np.take_along_axis(e, tags[:, :, None], axis=2)[:, :, 0].sum(axis=0) + self.moves()[tags[:-1], tags[1:]].sum(axis=0)
        d_e = np.exp(alpha + beta - total[None, :, None])
        np.put_along_axis(d_e, tags[:, :, None], np.take_along_axis(d_e, tags[:, :, None], axis=2) - 1, axis=2)
        left, right = alpha[:-1], e[1:] + beta[1:]
        top = left.max(axis=2, keepdims=True)
        pairs = np.exp(left - top).reshape(-1, N_TAGS).T @ np.exp(right + top - total[None, :, None]).reshape(-1, N_TAGS)
        d_move = pairs * weight
        np.subtract.at(d_move, (tags[:-1].ravel(), tags[1:].ravel()), 1)
        d_e /= batch
        grads = {"out": both.reshape(-1, 2 * n).T @ d_e.reshape(-1, N_TAGS), "bias": d_e.sum(axis=(0, 1)), "move": np.where(_ALLOWED, d_move / batch, 0)}
        d_both = d_e @ self.params["out"].T
        d_out = np.stack([d_both[:, :, :n], d_both[::-1, :, n:]])
        back = self.params["rec"].transpose(0, 2, 1)
        dz = np.empty((2, steps, batch, 4 * n), np.float32)
        d_h, d_c = np.zeros((2, batch, n), np.float32), np.zeros((2, batch, n), np.float32)
        for t in range(steps - 1, -1, -1):
            gate, new, before, tc = trace[t]
            dh = d_out[:, t] + d_h
            dc = d_c + dh * gate[..., 2 * n :] * (1 - tc * tc)
            d_gate = np.concatenate([dc * new, dc * before, dh * tc], axis=2) * gate * (1 - gate)
            dz[:, t] = np.concatenate([d_gate, dc * gate[..., :n] * (1 - new * new)], axis=2)
            d_h, d_c = dz[:, t] @ back, dc * gate[..., n : 2 * n]
        flat = dz.reshape(2, -1, 4 * n)
        earlier = np.concatenate([np.zeros((2, 1, batch, n), np.float32), out[:, :-1]], axis=1).reshape(2, -1, n)
        grads["rec"] = earlier.transpose(0, 2, 1) @ flat
        one_hot = np.eye(N_CLASSES, dtype=np.float32)
        grads["in"] = np.stack([one_hot[x.ravel()].T @ flat[0], one_hot[x[::-1].ravel()].T @ flat[1]])
        return float((total - gold).mean()), grads

    def decode(self, x: np.ndarray) -> list[list[tuple[int, int, int, float]]]:
        """Per window of the batch: spans (kind, start, end, margin over no span)."""
        e, move = self.emissions(x), self.moves()
        steps, batch = x.shape
        score = np.where(_START, e[0], FORBIDDEN)
        back = np.empty((steps, batch, N_TAGS), np.int8)
        for t in range(1, steps):
            s = score[:, :, None] + move[None]
            back[t] = s.argmax(axis=1)
            score = s.max(axis=1) + e[t]
        tags = np.empty((steps, batch), np.int8)
        tags[-1] = score.argmax(axis=1)
        at = np.arange(batch)
        for t in range(steps - 1, 0, -1):
            tags[t - 1] = back[t][at, tags[t]]
        # What each character of the path gains over no tag, the move into it included.
        margin = np.take_along_axis(e, tags[:, :, None].astype(np.int64), axis=2)[:, :, 0] - e[:, :, 0]
        margin[1:] += move[tags[:-1], tags[1:]] - move[0, 0]
        found = []
        for b in range(batch):
            own, spans = tags[:, b], []
            for s in np.flatnonzero(own % 2 == 1):
                end = s + 1
                while end < steps and own[end] == own[s] + 1:
                    end += 1
                spans.append((int(own[s] - 1) // 2, int(s), int(end), float(margin[s:end, b].sum())))
            found.append(spans)
        return found


# Training.


def _made_up(kind: int, r: random.Random) -> str:
    digits = lambda n: "".join(r.choices("0123456789", k=n))
    letters = lambda a, b: "".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randint(a, b)))
    if kind == 0:
        local = letters(2, 9) + r.choice(["", "." + letters(1, 6), "." + digits(2), "_" + digits(2), "+" + letters(2, 4), digits(2)])
        return local + "@" + ".".join(letters(2, 8) + r.choice(["", digits(1)]) for _ in range(r.randint(1, 2))) + "." + letters(2, 3)
    if kind == 1:
        return ".".join(str(r.randint(0, 255)) for _ in range(4))
    if kind == 2:
        body = digits(r.choice([12, 13, 14, 15, 15, 15, 15, 16, 18]))
        number = next(body + c for c in "0123456789" if luhn(body + c))
        gap = r.choice(["", "", "", " ", "-"])
        return gap.join(number[i : i + 4] for i in range(0, len(number), 4))
    code = "+" + r.choice(["1", "1", "44", "49", "33", "34", "351"])
    return code + r.choice([f" ({digits(3)}) {digits(3)}-{digits(4)}", f" {digits(3)} {digits(3)} {digits(4)}", f"-{digits(3)}-{digits(3)}-{digits(4)}", f" {digits(2)} {digits(4)} {digits(4)}", digits(9)])


def _spelled(kind: int, r: random.Random) -> str:
    """A value in a spelling that the base patterns miss."""
    digits = lambda n: "".join(r.choices("0123456789", k=n))
    if kind == 0:
        local, _, domain = _made_up(0, r).partition("@")
        at = r.choice(["[at]", " [at] ", "(at)", " (at) ", "{at}", " <at> "])
        return local + at + domain.replace(".", r.choice([".", "[dot]", " [dot] ", "(dot)", " (dot) ", "[.]"]))
    if kind == 1:
        return _made_up(1, r).replace(".", r.choice(["[.]", "(.)", "[dot]", "(dot)", " [.] "]))
    if kind == 2:
        number = _NOT_DIGIT.sub("", _made_up(2, r))
        return r.choice([".", "/", "_", "  ", " - ", "\xa0"]).join(number[i : i + 4] for i in range(0, len(number), 4))
    a, b, c = digits(3), digits(3), digits(4)
    return r.choice([f"({a}) {b}-{c}", f"({a}) {b} {c}", f"({a}){b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"0{a}/{b}{c}", f"0{digits(2)} {digits(4)} {c}", f"00{digits(2)} {a} {b}{c}"])


def _no_value(r: random.Random) -> str:
    """A number or sign that is no personal data."""
    digits = lambda n: "".join(r.choices("0123456789", k=n))
    date = f"{r.randint(1900, 2030)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}"
    return r.choice(
        [
            digits(r.randint(1, 12)), f"{r.randint(1, 31)}.{r.randint(1, 12)}.{r.randint(1990, 2030)}", f"{r.random():.3f}",
            f"v{r.randint(1, 9)}.{r.randint(0, 9)}", f"{r.randint(0, 23)}:{r.randint(10, 59)}", f"@{r.choice('abc')}x",
            date, f"{date} {digits(2)}:{digits(2)}:{digits(2)}", f"{date}T{digits(2)}:{digits(2)}Z", f"{r.randint(1, 12)}/{r.randint(1, 28)}/{r.randint(1990, 2030)}",
            f"978-{digits(1)}-{digits(2)}-{digits(6)}-{digits(1)}", f"{digits(3)}-{digits(2)}-{digits(4)}", f"{r.randint(1, 999):,}" + "".join(f",{digits(3)}" for _ in range(r.randint(1, 3))),
            " ".join([digits(r.randint(1, 3)), *(digits(3) for _ in range(r.randint(1, 3)))]), f"{digits(r.randint(2, 4))}-{digits(r.randint(2, 4))}",
            " ".join(str(r.randint(1900, 2030)) for _ in range(r.randint(2, 3))), ", ".join(digits(r.randint(1, 4)) for _ in range(r.randint(2, 5))),
            f"({r.randint(1900, 2030)})", f"[{digits(r.randint(1, 2))}]", f"${digits(2)}.{digits(2)}", ".".join(digits(1) for _ in range(r.choice([3, 5, 6]))),
            " (at) ", " [at] ", f"{digits(2)}AB-{digits(4)}-{digits(4)}", f"1-{digits(3)}",
        ]
    )


def labelled_windows(texts: list[str], n: int, width: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes and tags (time, window) of ``n`` windows."""
    r = random.Random(seed)
    texts = [t for t in texts if t.strip()] or ["words without data"]
    xs, ys = [], []

    def add(text: str, spans: list[Span], at: int) -> None:
        tags = np.zeros(len(text), np.int8)
        for kind, a, b in spans:
            tags[a:b] = 2 + 2 * kind
            tags[a] = 1 + 2 * kind
        x, y = np.zeros(width, np.int8), np.zeros(width, np.int8)
        part = slice(at, at + width)
        x[: len(text[part])], y[: len(text[part])] = classes(text)[part], tags[part]
        if y[0] and y[0] % 2 == 0:  # the window begins inside a span
            y[0] -= 1
        xs.append(x)
        ys.append(y)

    while len(xs) < n:
        text = r.choice(texts)
        own = base_spans(text) if len(xs) % 4 == 0 else []
        clear = [s for s in own if not any(o is not s and o[1] < s[2] and s[1] < o[2] for o in own)]
        if clear and len(clear) == len(own):
            kind, a, b = r.choice(clear)
            low = max(0, a - width)
            part = text[low : b + width]
            add(part, [(k, s - low, e - low) for k, s, e in clear if s >= low and e <= low + len(part)], max(0, a - low - r.randint(0, width // 2)))
            continue
        i = r.randrange(len(text))
        left, right = text[max(0, i - width) : i], text[i : i + width]
        if _ANCHOR.search(left + right):
            left, right = _ANCHOR.sub("", left), _ANCHOR.sub("", right)
        mode = r.random()
        made, spans = left + r.choice([" ", " ", "\n", ": "]), []
        if mode < 0.7:
            for _ in range(r.choice([1, 1, 2, 2, 3, 4])):
                kind = r.choice((0, 1, 2, 3, 3, 3))  # phones have the most forms
                value = r.choice([_made_up, _spelled])(kind, r)
                spans.append((kind, len(made), len(made) + len(value)))
                made += value + r.choice([" ", " ", " ", ", ", "\n", "; "])
        else:  # numbers that are no personal data
            for _ in range(r.choice([1, 2, 3])):
                made += _no_value(r) + r.choice([" ", ", ", " the ", ". "])
        made += right
        add(made, spans, max(0, len(left) - r.randint(0, width // 2)))
    return np.array(xs).T.copy(), np.array(ys).T.copy()


def train_tagger(texts: list[str], hidden: int = 24, windows: int = 8000, width: int = 96, rounds: int = 6, seed: int = 5) -> Tagger:
    x, y = labelled_windows(texts, windows, width, seed)
    model, batch = Tagger.fresh(hidden, seed), 64
    m = {k: np.zeros_like(v) for k, v in model.params.items()}
    v2 = {k: np.zeros_like(v) for k, v in model.params.items()}
    order, step = np.random.default_rng(seed), 0
    total = rounds * (windows // batch)
    for _ in range(rounds):
        for part in np.array_split(order.permutation(windows), windows // batch):
            step += 1
            _, grads = model.step(x[:, part], y[:, part].astype(np.int64))
            size = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            rate = 0.01 * (1 - 0.95 * step / total)
            for k, g in grads.items():
                g = g * min(1, 5 / (size + 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * g
                v2[k] = 0.99 * v2[k] + 0.01 * g * g
                model.params[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v2[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return model


# Finding.


def windows_of(text: str, width: int, reach: int) -> list[int]:
    """Starts of overlapping windows that cover all within ``reach`` characters of a digit or ``@``."""
    starts, until = [], 0
    for m in _ANCHOR.finditer(text):
        low, high = max(0, m.start() - reach), min(len(text), m.start() + reach + 1)
        if not starts or low > until:
            starts.append(low)
            until = low + width
        while until < high:
            starts.append(until - width // 2)
            until = starts[-1] + width
    return starts


def reconcile(spans: list[tuple[int, int, int, float]]) -> list[Span]:
    """The spans without overlaps that have the highest total margin."""
    best: dict[Span, float] = {}
    for kind, a, b, s in spans:
        best[(kind, a, b)] = max(s, best.get((kind, a, b), s))
    ranked = sorted(((b, a, kind, s) for (kind, a, b), s in best.items() if s > 0))
    ends, totals, chosen = [], [0.0], []
    for b, a, _, s in ranked:
        before = int(np.searchsorted(ends, a, side="right"))
        take = totals[before] + s
        chosen.append((take > totals[-1], before))
        ends.append(b)
        totals.append(max(take, totals[-1]))
    out, i = [], len(ranked)
    while i:
        took, before = chosen[i - 1]
        if took:
            b, a, kind, _ = ranked[i - 1]
            out.append((kind, a, b))
        i = before if took else i - 1
    return sorted(out)


def find_spans(texts: list[str], model: Tagger, width: int = 96, reach: int = 40, batch: int = 256) -> list[tuple[list[Span], list[Span]]]:
    """Per text: base spans, and those the model adds."""
    base = [base_spans(t) for t in texts]
    where = [(i, s) for i, t in enumerate(texts) for s in windows_of(t, width, reach)]
    raw: list[list] = [[] for _ in texts]
    coded: tuple[int, np.ndarray | None] = (-1, None)
    for k in range(0, len(where), batch):
        part = where[k : k + batch]
        x = np.zeros((len(part), width), np.int8)
        for row, (i, s) in enumerate(part):
            if coded[0] != i:
                coded = (i, classes(texts[i]))
            piece = coded[1][s : s + width]
            x[row, : len(piece)] = piece
        for (i, s), spans in zip(part, model.decode(x.T), strict=True):
            raw[i] += [(kind, s + a, s + b, score) for kind, a, b, score in spans]
    out = []
    for text, own, found in zip(texts, base, raw, strict=True):
        checked = []
        for kind, a, b, score in found:
            b = min(b, len(text))  # not into the padding
            while a < b and text[a] in " \n,;:.-)":
                a += 1
            while b > a and text[b - 1] in " \n,;:.-(+":
                b -= 1
            if a >= b or any(x < b and a < y for _, x, y in own):
                continue
            # Part of a longer number is no find of its own.
            if valid(kind, text[a:b]):
                whole = not (text[a - 1 : a].isdigit() or text[b : b + 1].isdigit())
            else:
                whole = score >= LOOSE_MARGIN and loosely_valid(kind, text[a:b])
                whole = whole and not (_NUMBER_BEFORE.search(text[max(0, a - 2) : a]) or _NUMBER_AFTER.match(text, b))
            if whole:
                checked.append((kind, a, b, score))
        out.append((own, reconcile(checked)))
    return out


def trained_on(docs: DataFrame, text_column: str, id_column: str, sample_rows: int, sample_chars: int) -> Tagger:
    """A model fitted on a bounded sample of the texts, at most ``sample_chars`` of each.

    Rows are chosen by a hash of their id before any text leaves a task.
    """
    known = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("txt")).where("txt is not null")
    chosen = bounded_sample(known, sample_rows, "id").select(F.xxhash64("id").alias("h"), F.substring("txt", 1, sample_chars).alias("txt"))
    return train_tagger([txt for _, txt in sorted((r["h"], r["txt"]) for r in chosen.collect())])


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def find_personal_data(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    sample_rows: int = 400,
    sample_chars: int = 2000,
    with_rows: bool = False,
) -> DataFrame:
    """(id, base, spans, redacted) per document row, and the whole row as ``row`` if asked.

    ``base`` and ``spans`` are ``kind:start:end`` joined by commas, in the order of kinds, then
    starts; ``redacted`` is the text with each span replaced by its kind in brackets. The model is
    trained once per call, on ``sample_rows`` texts of at most ``sample_chars`` characters.
    """
    model = trained_on(docs, text_column, id_column, sample_rows, sample_chars)

    def redact(text: str, spans: list[Span]) -> str:
        out, at = [], 0
        for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
            if a >= at:
                out += [text[at:a], f"[{KINDS[kind]}]"]
            at = max(at, b)
        return "".join([*out, text[at:]])

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                texts = part.column(part.num_columns - 1).to_pylist()
                found = find_spans(texts, model)
                columns = [
                    *part.columns[:-1],
                    pa.array([_joined(b) for b, _ in found], pa.string()),
                    pa.array([_joined(b + m) for b, m in found], pa.string()),
                    pa.array([redact(t, b + m) for t, (b, m) in zip(texts, found, strict=True)], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    kept = [F.col(id_column), *([F.struct("*").alias("row")] if with_rows else [])]
    given = docs.select(*kept, F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("_pii_text"))
    out = given.drop("_pii_text").schema
    for name in ("base", "spans", "redacted"):
        out = out.add(name, "string")
    names = out.names
    return given.mapInArrow(returning_memory(run), out)
