"""Personal data: exact patterns, and a linear-chain conditional random field that adds what the patterns miss.

The field labels tokens (runs of what is not white space) with O or B-/I- of a kind, from word-shape features of a token, the shapes
and words next to it and the word before those. It is trained on the driver from a small labelled table (a parameter; the
default one is made by rule from carriers and value forms) and decoded by Viterbi in numpy batches. A span needs a token with a
digit, "@" or a spelled-out "at" or "dot"; so chains are windows of AROUND tokens on either side of such tokens, joined where
they touch, and all other tokens are O without being scored. What the field says is the span; a card must pass its checksum, an address of four
numbers their range, and no added span overlaps a base one.

One Arrow pass, no shuffle. A batch of chains has at most CELLS padded tokens; a longer chain is decoded by itself and its
path is fixed as far as all survivors agree, so that memory does not follow the length of a text of numbers.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from functools import cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import spread, table

KINDS = ("email", "ip", "card", "phone")
#: The field has one kind more: keys, tokens and passwords.
ADDED = (*KINDS, "secret")
LABELS = ("O", *[f"{p}-{k}" for k in ADDED for p in "BI"])
AROUND = 4
#: Padded tokens decoded at a time, and tokens whose scores a worker remembers.
CELLS, REMEMBERED = 1 << 15, 1 << 14

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: Numbers are taken from their first digit; a start within a run of digits can't match where its first digit doesn't.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TOKEN = re.compile(r"\S+")
_SEED = re.compile(r"[0-9@]|[(\[{](?:at|dot|AT|DOT)[)\]}]|(?<!\S)(?:dot|DOT)(?!\S)")


def luhn(digits: str) -> bool:
    total = 0
    for k, x in enumerate(reversed(digits)):
        d = int(x) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _octets(parts: list[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def _only_digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all pattern matches, by start and then kind as listed."""
    if not text:
        return []
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end(), "email"))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    if _DIGIT.search(text):
        out += [(*m.span(), "ip") for m in _IP.finditer(text) if _octets(m[0].split("."))]
        out += [(*m.span(), "card") for m in _CARD.finditer(text) if 14 <= len(d := _only_digits(m[0])) <= 19 and luhn(d)]
        out += [(*m.span(), "phone") for m in _PHONE.finditer(text) if 10 <= len(_only_digits(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


# -- the field --------------------------------------------------------------------------------------------------------


def _shape(token: str) -> str:
    s = re.sub(r"[A-Z]", "A", re.sub(r"[a-z]", "a", re.sub(r"[0-9]", "9", token[:40])))
    return re.sub(r"([Aa])\1+", r"\1", re.sub(r"[^\x00-\x7f]", "u", s))


def _word(token: str) -> str:
    return token.lower().strip(".,;:()[]\"'") if len(token) < 16 else ""


def _own(token: str) -> list[str]:
    s, n = _shape(token), sum("0" <= c <= "9" for c in token)
    core = re.sub(r"^[^A-Za-z0-9]+|[^A-Za-z0-9]+$", "", token)
    runs = re.findall("[0-9]+", core)
    mixed = len(core) >= 16 and 0 < n and any(c.isalpha() for c in core) and core.isascii()
    return [
        f"s={s}", f"r={re.sub(r'9+', '9', s)}", f"n={min(n, 20)}", f"w={_word(token)}", f"@={'@' in token}", f"p={'.' in token[:-1]}", f"e={token[-1:] in '.,;!'}",
        f"m={mixed}", f"x={mixed and re.fullmatch('[0-9a-fA-F]+', core) is not None}", f"q={token[:1] in chr(34) + chr(39)}", f"={'=' in token[:-1]}",
        f"c={re.sub(r'9+', '9', _shape(core))}", f"k={len(runs)}", f"k={len(runs)},{max(map(len, runs), default=0)}", f"g={'-'.join(str(len(x)) for x in runs[:6])}",
    ]


def _beside(token: str | None) -> list[str]:
    return ["<>"] if token is None else ["r=" + re.sub(r"9+", "9", _shape(token.strip(".,;:!?#$%&*\"'"))), "w=" + _word(token)]


def _near(tokens: list[str], at: int) -> str | None:
    return tokens[at] if 0 <= at < len(tokens) else None


def features(tokens: list[str], at: int) -> list[str]:
    """All features of a token in its chain."""
    before, after, early = _near(tokens, at - 1), _near(tokens, at + 1), _near(tokens, at - 2)
    return [*["0" + f for f in _own(tokens[at])], *["1" + f for f in _beside(before)], *["2" + f for f in _beside(after)], *["3" + f for f in _beside(early)[-1:]]]


class Field:
    """Feature weights, each a row over LABELS; trans[from, to]; begin."""

    def __init__(self, known: dict[str, int], weights: np.ndarray, trans: np.ndarray, begin: np.ndarray):
        self.known, self.weights, self.trans, self.begin = known, weights, trans, begin
        self._at: dict[str | None, int] = {}
        self._rows = None

    def __getstate__(self):
        return self.known, self.weights, self.trans, self.begin

    def __setstate__(self, state):
        self.__init__(*state)

    def _sum(self, names: list[str]) -> np.ndarray:
        at = [k for n in names if (k := self.known.get(n)) is not None]
        return self.weights[at].sum(0) if at else np.zeros(len(LABELS))

    def _row(self, token: str | None) -> int:
        k = self._at.get(token)
        if k is None:
            self._at[token] = k = len(self._at)
            beside = _beside(token)
            own = np.zeros(len(LABELS)) if token is None else self._sum(["0" + f for f in _own(token)])
            self._rows[:, k] = own, self._sum(["1" + f for f in beside]), self._sum(["2" + f for f in beside]), self._sum(["3" + f for f in beside[-1:]])
        return k

    def emissions(self, tokens: list[str], before: list[str | None] = (), after: list[str | None] = ()) -> np.ndarray:
        """Scores of tokens; before: the two tokens ahead of them, after: the one behind them, None where there is none."""
        every = [*(before or (None, None)), *tokens, *(after or (None,))]
        if self._rows is None or len(self._at) + len(every) > REMEMBERED:
            self._at.clear()
            self._rows = np.zeros((4, max(REMEMBERED, len(every)), len(LABELS)))
        k, n = np.fromiter(map(self._row, every), np.intp, len(every)), len(tokens)
        return self._rows[0, k[2 : n + 2]] + self._rows[1, k[1 : n + 1]] + self._rows[2, k[3 : n + 3]] + self._rows[3, k[:n]]

    def decode(self, chains: list[list[str]]) -> list[np.ndarray]:
        """The best label numbers of every chain; short chains of like length run together, long ones by themselves."""
        out: list = [None] * len(chains)
        order = sorted(range(len(chains)), key=lambda k: len(chains[k]))
        lo = 0
        while lo < len(order):
            hi = lo + 1
            while hi < len(order) and (hi + 1 - lo) * len(chains[order[hi]]) <= CELLS:
                hi += 1
            if len(chains[order[lo]]) > CELLS:
                out[order[lo]] = self._long(chains[order[lo]])
            else:
                for k, labels in zip(order[lo:hi], self._together([chains[k] for k in order[lo:hi]]), strict=True):
                    out[k] = labels
            lo = hi
        return out

    def _together(self, chains: list[list[str]]) -> list[np.ndarray]:
        sizes = np.array([len(c) for c in chains])
        e = np.zeros((len(chains), sizes.max(), len(LABELS)))
        for n, c in enumerate(chains):
            e[n, : len(c)] = self.emissions(c)
        back = np.zeros(e.shape, np.int8)
        score = self.begin + e[:, 0]
        for t in range(1, e.shape[1]):
            both = score[:, :, None] + self.trans
            best = both.argmax(1)
            live = (t < sizes)[:, None]
            back[:, t] = np.where(live, best, np.arange(len(LABELS)))
            score = np.where(live, np.take_along_axis(both, best[:, None], 1)[:, 0] + e[:, t], score)
        path = np.zeros(e.shape[:2], np.int8)
        path[:, -1] = score.argmax(1)
        rows = np.arange(len(chains))
        for t in range(e.shape[1] - 1, 0, -1):
            path[:, t - 1] = back[rows, t, path[:, t]]
        return [path[n, : len(c)] for n, c in enumerate(chains)]

    def _long(self, chain: list[str], step: int = 4096) -> np.ndarray:
        """One chain, step tokens at a time. Where all survivors have one path, that is final and its pointers go."""
        out, done, score, back = np.zeros(len(chain), np.int8), 0, None, []
        for lo in range(0, len(chain), step):
            piece = chain[lo : lo + step]
            for x in self.emissions(piece, [_near(chain, lo - 2) if lo > 1 else None, _near(chain, lo - 1) if lo else None], [_near(chain, lo + len(piece))]):
                if score is None:
                    score = self.begin + x
                    continue
                both = score[:, None] + self.trans
                back.append(both.argmax(0).astype(np.int8))  # of token done + len(back)
                score = both.max(0) + x
            last = lo + len(piece) == len(chain)
            alive = np.array([score.argmax()]) if last else np.arange(len(LABELS))
            for k in range(len(back) - 1, -1, -1):
                if len(alive) == 1:
                    out[done + k + 1] = alive[0]
                alive = np.unique(back[k][alive])
                if not last and len(alive) == 1:  # token done + k has one label, and so have all before it
                    out[done + k], rest = alive[0], back[k:]
                    for j in range(k - 1, -1, -1):
                        out[done + j] = back[j][out[done + j + 1]]
                    done, back = done + k, rest
                    break
            else:
                if last:
                    out[done] = alive[0]
        return out


def train(table_: list[tuple[list[str], list[str]]], steps: int = 100, ridge: float = 0.1, rate: float = 0.2) -> Field:
    """table_: sentences as (tokens, labels). Adam on the penalized log likelihood, from zero: no randomness. Features that
    one token only has are left out."""
    from collections import Counter

    named = [[features(tokens, n) for n in range(len(tokens))] for tokens, _ in table_]
    often = Counter(f for s in named for t in s for f in t)
    known = {f: k for k, f in enumerate(sorted(f for f, n in often.items() if n > 1))}
    size, longest, labels, most = len(known), max(len(t) for t, _ in table_), len(LABELS), max(len(t) for s in named for t in s)
    ids = np.full((len(table_), longest, most), size)
    y, live = np.zeros((len(table_), longest), int), np.zeros((len(table_), longest), bool)
    for n, (tokens, said) in enumerate(table_):
        live[n, : len(tokens)] = True
        y[n, : len(tokens)] = [LABELS.index(v) for v in said]
        for t, f in enumerate(named[n]):
            have = [known[x] for x in f if x in known]
            ids[n, t, : len(have)] = have
    hot = np.eye(labels)[y] * live[:, :, None]
    pairs = np.einsum("nti,ntj->ij", hot[:, :-1], hot[:, 1:])
    allowed = np.array([[not b.startswith("I-") or a[2:] == b[2:] for b in LABELS] for a in LABELS])
    first = np.array([not b.startswith("I-") for b in LABELS])
    p = [np.zeros((size + 1, labels)), np.zeros((labels, labels)), np.zeros(labels)]
    moment, square = [np.zeros_like(v) for v in p], [np.zeros_like(v) for v in p]
    flat = ids.reshape(-1)
    for step in range(1, steps + 1):
        trans, begin = np.where(allowed, np.exp(p[1]), 0.0), np.where(first, np.exp(p[2]), 0.0)
        e = p[0][ids].sum(2)
        e = np.exp(e - e.max(2, keepdims=True))
        alpha, scale = np.zeros_like(e), np.ones((len(table_), longest))
        now = begin * e[:, 0]
        for t in range(longest):
            if t:
                now = np.where(live[:, t, None], (alpha[:, t - 1] @ trans) * e[:, t], 0.0)
            scale[:, t] = np.where(live[:, t], now.sum(1), 1.0)
            alpha[:, t] = now / scale[:, t, None]
        beta, edge = np.ones_like(e), np.zeros((labels, labels))
        for t in range(longest - 2, -1, -1):
            ahead = np.where(live[:, t + 1, None], e[:, t + 1] * beta[:, t + 1] / scale[:, t + 1, None], 0.0)
            edge += alpha[:, t].T @ ahead
            beta[:, t] = np.where(live[:, t + 1, None], ahead @ trans.T, 1.0)
        rest = (hot - alpha * beta * live[:, :, None]).reshape(-1, labels)
        wide = np.repeat(rest, most, 0)
        grads = [np.stack([np.bincount(flat, wide[:, k], size + 1) for k in range(labels)], 1) - ridge * p[0], (pairs - edge * trans) * allowed - ridge * p[1], ((hot[:, 0] - alpha[:, 0] * beta[:, 0]).sum(0)) * first - ridge * p[2]]
        grads[0][size] = 0
        for n, g in enumerate(grads):
            moment[n] = 0.9 * moment[n] + 0.1 * g
            square[n] = 0.99 * square[n] + 0.01 * g * g
            p[n] = p[n] + rate * (moment[n] / (1 - 0.9**step)) / (np.sqrt(square[n] / (1 - 0.99**step)) + 1e-6)
    return Field(known, p[0], np.where(allowed, p[1], -1e4), np.where(first, p[2], -1e4))


# -- the labelled table -----------------------------------------------------------------------------------------------


def _digits(r, n: int) -> str:
    return "".join(r.choice("0123456789") for _ in range(n))


def _card(r) -> str:
    body = r.choice("3456") + _digits(r, 14)
    return next(body + d for d in "0123456789" if luhn(body + d))


def _hex(r, n: int) -> str:
    return "".join(r.choice("0123456789abcdef") for _ in range(n))


def _mixed(r, n: int) -> str:
    return "".join(r.choice("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz23456789") for _ in range(n))


_NAMES = "anna joe max info lena p.smith sales maria k_wong support tom.b office jan contact luis eva99 webmaster hr".split()
_HOSTS = "mail corp shop example acme node web my-firm uni city post cloud".split()
_ENDS = "com org net de fr es info co".split()
_CALL = ["call", "tel", "phone", "Tel:", "mobile:", "fax", "dial", "ring"]


def _value(kind: str, r) -> str:
    """One value of a kind in a form that the base patterns miss."""
    if kind == "email":
        at, dot = r.choice([("(at)", "(dot)"), ("[at]", "[dot]"), ("{at}", "{dot}"), ("at", "dot"), ("AT", "DOT"), ("(at)", "(dot)"), ("[AT]", "[DOT]")])
        return " ".join([r.choice(_NAMES), at, *[x for _ in range(r.choice((1, 1, 2, 3))) for x in (r.choice(_HOSTS), dot)], r.choice(_ENDS)])
    if kind == "ip":
        n = [str(r.randint(0, 255)) for _ in range(4)]
        return r.choice(["[.]", "(.)", "[dot]", " [.] "]).join(n)
    if kind == "card":
        c = _card(r)
        return r.choice(["/", ".", "_", ":"]).join(c[k : k + 4] for k in range(0, 16, 4))
    if kind == "phone":
        a, b, c = _digits(r, 3), _digits(r, 3), _digits(r, 4)
        return r.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"({a}) {b} {c}", f"{a} {b}-{c}", f"{a} {b} {c}", f"{a}.{b}.{c}", f"0{a}/{b}{c}", f"({a}){b}-{c}", f"00{a[:2]} {b} {c}"])
    return r.choice([_hex(r, 40), _hex(r, 32), _hex(r, 40).upper(), _mixed(r, 24), _mixed(r, 40), _hex(r, 64)])


_CARRIERS = {
    "any": ["write to <> today", "<>", "the <> is known, and so", "he said: <> and left", "und der <> die", "que la <> de", "it is <>.", "reach us: <> or come by", "see <> and <> for more", "<>, <>", "my old one was <> but now <>", "contact <> (work) or <> (home)", "en el <> la", "list: <> <> <>", "is it <>?", "please use <>, thanks", "avec <> pour", "note <>; then go on"],
    "email": ["mail <> for help", "send it to <>", "e-mail: <>", "from <> to all", "ask <> or <>"],
    "phone": ["call <> or come", "tel <>", "phone: <>", "Tel. <> after six", "dial <> now", "fax <>, room 12", "numbers <>, <>", "mobile <> or <>", "ring <> at 9"],
    "ip": ["host <> is down", "ping <> fails", "from <> to <>", "server <> port 80"],
    "card": ["pay with <> please", "card <> expires 05/27", "charged to <>", "visa <>, <>"],
    "secret": ["token = <>", "token = <> and more of it", "api_key: <>", "the secret = <> was there", "password = <>", "Bearer <>", "TOKEN = <>", "key = <> ende", "auth token <> la", "export KEY = <>"],
}
_PLAIN = ["it was {date} at {time}", "version {ver} has {n} parts", "about {n} of {big} men", "room {n} and {n} or {n}", "id {d16} stays", "on page {n}, line {n}.", "in {year} or {year} the", "see ({n}) and [{n}] of {n}", "a total of {n} and {n} things", "@home with @friends", "ratio {f} to {f}", "the end at dot com", "a@b and c@d", "{d3} is a number", "x1 y2 z{n} of {n}%", "order {d10} was sent", "{big} people came", "{n} {n} {n} {n}", "{f} {f} {f} {f}", "der {n}. mai {year}", "le {n} mars {year} la", "section {ver} of the", "licensed under version {f}", "commit {hex7} fixes #{n}", "item {d10}, lot {d4}-{d4}", "{d3}-{d2}-{d4} is a form", "isbn {d3}-{d1}-{d4}-{d4}-{d1}", "at {time} dot on it", "the (at) sign and a dot", "open {time}-{time}", "look at the dot there", "en {year} la {n} de", "{d16} raie,", "price $ {f} or {f} eur", "sha {hex40} of the tree", "commit {hex40} by me", "{d2}/{d2}/{d4} and {d2}.{d2}.{d4}", "cc by {ver}", "{n}x{n} pixels", "ip v4 and v6", "{d4} {d4} units", "the {d16} on re", "{d16}!! of!!", "score {n}:{n}, {n}:{n}", "col {f}, {f}, {f}", "gene p{d2} and k{d3}"]


def labelled_table(size: int = 900, seed: int = 1, part: int | None = None) -> list[tuple[list[str], list[str]]]:
    """Labelled sentences, made by rule: carriers with "<>" slots filled with values, in white space, quotes or junk, and plain
    sentences with numbers that are no personal data. part 0 or 1: only every second carrier and sentence, so that one part
    can be held out."""
    import random

    r, out = random.Random(seed), []
    mine = lambda xs: xs if part is None else xs[part::2]
    plain = {"n": lambda: str(r.randint(1, 999)), "big": lambda: f"{r.randint(1, 999)},{_digits(r, 3)}", "f": lambda: f"{r.randint(0, 99)}.{r.randint(0, 99)}", "ver": lambda: f"{r.randint(0, 9)}.{r.randint(0, 20)}.{r.randint(0, 9)}", "year": lambda: str(r.randint(1900, 2030)), "date": lambda: f"20{_digits(r, 2)}-0{r.randint(1, 9)}-{r.randint(10, 28)}", "time": lambda: f"{r.randint(0, 23)}:{r.randint(10, 59)}"}
    plain |= {f"d{n}": (lambda n=n: _digits(r, n)) for n in (1, 2, 3, 4, 10)} | {f"hex{n}": (lambda n=n: _hex(r, n)) for n in (7, 40)}
    plain["d16"] = lambda: next(d for d in iter(lambda: _digits(r, 16), "") if not luhn(d))
    ends = ["", "", "", ".", ",", "!!", "###", "$$$", ";"]
    for k in range(size):
        if k % 5 < 2:
            text = re.sub(r"\{(\w+)\}", lambda m: plain[m[1]](), r.choice(mine(_PLAIN)))
            tokens = text.split()
            if r.random() < 0.2:
                tokens = [t + "!!" for t in tokens]
            out.append((tokens, ["O"] * len(tokens)))
            continue
        kind = ADDED[k // 5 % len(ADDED)]
        carrier, tokens, labels = r.choice(mine(_CARRIERS[kind] + ([] if kind == "secret" else _CARRIERS["any"]))), [], []
        for part_ in re.split(r"(<>)", carrier):
            if part_ != "<>":
                rest = part_.split() if not (tokens and part_[:1] not in ("", " ")) else None
                if rest is None:  # what touches the value
                    glued, _, more = part_.partition(" ")
                    tokens[-1] += glued
                    rest = more.split()
                tokens += rest
                labels += ["O"] * len(rest)
                continue
            value = _value(kind, r)
            if kind == "phone" and r.random() < 0.1:
                value = _digits(r, 10)
                tokens.append(r.choice(_CALL))
                labels.append("O")
            if kind == "secret" and r.random() < 0.8:
                value = f'"{value}"' if r.random() < 0.8 else f"'{value}'"
            value += r.choice(ends) if carrier.endswith("<>") or carrier.count("<>") == 1 and " " in carrier and r.random() < 0.2 else ""
            got = value.split()
            tokens += got
            labels += [f"B-{kind}"] + [f"I-{kind}"] * (len(got) - 1)
        out.append((tokens, labels))
    return out


def _trimmed(kind: str, text: str, a: int, b: int) -> tuple[int, int]:
    """The span without what stands around a value: quotes, brackets, punctuation, and the name that a secret is given to."""
    while b > a and not (text[b - 1].isalnum() or kind == "secret" and text[b - 1] == "="):
        b -= 1
    opened = kind == "phone" and ")" in text[a:b]
    while a < b and not (text[a].isalnum() or opened and text[a] == "("):
        a += 1
    if kind == "secret" and (m := re.match(r"[A-Za-z_]+[=:][\"']?", text[a:b])):
        a += m.end()
    return a, b


def _sound(kind: str, s: str) -> bool:
    """What the field cannot count: the checksum of a card, the range of an address, the digits of a number, a secret's length,
    the one at of a mail address."""
    digits = _only_digits(s)
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    if kind == "ip":
        parts = re.findall(r"[0-9]+", s)
        return len(parts) == 4 and _octets(parts)
    if kind == "phone":
        return 7 <= len(digits) <= 15
    return len(s) >= 16 if kind == "secret" else re.search(r"@|(?i:\bat\b)", s) is not None


def chains_of(text: str) -> list[list[tuple[int, int]]]:
    """Token spans of every window around tokens that could be part of a span; windows that touch are one chain."""
    if not _SEED.search(text):
        return []
    tokens = [m.span() for m in _TOKEN.finditer(text)]
    ends = np.array([b for _, b in tokens])
    seeds = np.unique(np.searchsorted(ends, [m.start() for m in _SEED.finditer(text)], side="right"))
    lo, hi = np.maximum(seeds - AROUND, 0), np.minimum(seeds + AROUND + 1, len(tokens))
    cut = np.flatnonzero(lo[1:] > hi[:-1]) + 1
    return [tokens[a:b] for a, b in zip(lo[np.append(0, cut)].tolist(), hi[np.append(cut, len(hi)) - 1].tolist(), strict=True)]


def added_spans(texts: list[str], found: list[list[tuple]], field: Field) -> list[list[tuple]]:
    """What the field adds to the base spans of each text. Chains are decoded as soon as they have enough tokens."""
    out: list[list[tuple]] = [[] for _ in texts]
    held: list[tuple[int, list[tuple[int, int]]]] = []

    def flush():
        words = [[texts[n][a:b] for a, b in chain] for n, chain in held]
        for (n, chain), labels in zip(held, field.decode(words), strict=True):
            begins = np.flatnonzero((labels % 2 == 1)).tolist()  # B- labels are odd, O is 0, I- follows its B-
            taken = [(x, y) for x, y, _ in found[n]]
            starts = [x for x, _ in taken]
            for k in begins:
                stop = k + 1
                while stop < len(chain) and labels[stop] == labels[k] + 1:
                    stop += 1
                kind = LABELS[labels[k]][2:]
                a, b = _trimmed(kind, texts[n], chain[k][0], chain[stop - 1][1])
                near = taken[max(0, bisect_left(starts, a) - 4) : bisect_left(starts, b)]
                if a < b and _sound(kind, texts[n][a:b]) and not any(x < b and a < y for x, y in near):
                    out[n].append((a, b, kind))
        held.clear()

    size = 0
    for n, text in enumerate(texts):
        for chain in chains_of(text):
            held.append((n, chain))
            size += len(chain)
            if size > 2 * CELLS:
                flush()
                size = 0
    flush()
    return out


@cache
def default_field() -> Field:
    return train(labelled_table())


def find_pii(docs: DataFrame, text: str = "text", field: Field | None = None) -> DataFrame:
    """docs with base and spans: arrays of (kind, from, to) in code points, by start and then kind as listed; spans has
    the base ones and those that the field adds, among them secrets. A null or empty text has none; equal texts have equal
    spans, and rows are never joined or dropped. Columns of docs named base or spans are replaced, all others stay."""
    docs = docs.drop("base", "spans")
    sent = docs.sparkSession.sparkContext.broadcast(field or default_field())
    at = docs.columns.index(text)

    def run(batches):
        import pyarrow as pa

        model = sent.value
        kind = pa.list_(pa.struct([("kind", pa.string()), ("from", pa.int64()), ("to", pa.int64())]))
        listed = lambda spans: [{"kind": k, "from": a, "to": b} for a, b, k in spans]
        for batch in batches:
            texts = [x or "" for x in batch.column(at).to_pylist()]
            base = [base_spans(t) for t in texts]
            more = added_spans(texts, base, model)
            every = [sorted(b + m, key=lambda s: (s[0], ADDED.index(s[2]))) for b, m in zip(base, more, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([listed(b) for b in base], kind), pa.array([listed(e) for e in every], kind)], names=[*batch.schema.names, "base", "spans"])

    spans = "array<struct<kind:string,from:long,to:long>>"
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields], f"base {spans}", f"spans {spans}"])
    return docs.mapInArrow(run, schema)


def _joined(spans: str):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["from"].cast("string"), s["to"].cast("string"))), ",")


def op5_pii(spark, sf_dir: str) -> DataFrame:
    """Every row of documents, null texts as empty. n_added and n_secret count what the field adds to the base spans."""
    out = find_pii(spread(table(spark, sf_dir, "documents")).select("doc_id", "text"))
    of = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    counts = [of(k).alias(f"n_{k}") for k in KINDS]
    more = [(F.size("spans") - F.size("base")).cast("long").alias("n_added"), F.size(F.filter("spans", lambda s: s["kind"] == "secret")).cast("long").alias("n_secret"), F.size("spans").cast("long").alias("n_spans")]
    return out.select("doc_id", *counts, F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("spans").alias("spans"), *more)
