"""Personal data in texts: patterns, and a character tagger that finds what they miss.

The tagger is a bidirectional LSTM with a CRF over its scores, fitted in numpy on windows of a bounded sample of
documents. Labelled spans are the patterns' own and, put between words of the sampled texts, personal data in ways of
writing that the patterns miss (`FORMS`), next to numbers that are no personal data and labelled as such. Every kind
needs a digit, an `@` or a written-out "at", so windows are laid, with an overlap of half, wherever one stands. Scores of
overlapping windows are weighed by the distance from a window's edge and added, and each stretch of windows is then
decoded as one sequence, so a span that crosses windows is found whole and once. Stretches beyond LONG windows are
decoded in parts that overlap by MARGIN windows; a part gives the spans that begin in it. A span of the tagger must have
what its kind is made of (`plausible`), and gives way to spans of the patterns that it touches.

Defined cases: null and empty texts have no spans; without any text there is no tagger and the patterns' spans stand
alone; ids may be null or repeated, each row comes back once; extra columns are ignored. Places are code points.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from claimwright.llm.common import chunks

KINDS = ["email", "ip", "card", "phone"]
#: Documents with spans that the tagger is fitted on, at most, and windows from them.
SAMPLE_DOCS = 600
SAMPLE_WINDOWS = 3000
#: Spans and other numbers that are put into a sampled text.
INSERTS = 6
WINDOW, STEP = 64, 32
HIDDEN, EMBEDDING = 16, 12
STEPS, RATE, BATCH = 600, 0.03, 32
#: Least probability of a tagger's span, each of its characters.
SURE = 0.5
#: Windows of a stretch that are decoded at once, and their overlap; characters decoded side by side, with padding.
LONG, MARGIN = 128, 8
DECODED_AT_ONCE = 100_000
#: Characters of a span of the tagger, at most.
SPAN_CHARS = 100

# The patterns of the four kinds.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NUMBER = re.compile(r"[0-9]+")
TRIGGER = re.compile(r"[0-9@]|[\[({<] ?[Aa][Tt] ?[\])}>]|\b(?:at|AT)\b(?=.{1,40}?\b(?:dot|DOT)\b)", re.DOTALL)
SHAPE = re.compile(r"(?i)[\w.%+-]+\W{0,3}(@|\bat\b)\W{0,3}[\w-]+(\W{0,3}(\.|\bdot\b)\W{0,3}[\w-]+)+")


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return (sum(values[0::2]) + sum(sum(divmod(2 * v, 10)) for v in values[1::2])) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Around each `@`: linear however long the runs of letters are."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def pattern_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) by start, then kind."""
    out = [(a, b, 0) for a, b in emails(text)]
    out += [(m.start(), m.end(), 1) for m in IP.finditer(text)
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), m.end(), 2))
    if "+" in text:
        out += [(m.start(), m.end(), 3) for m in PHONE.finditer(text)
                if 9 <= sum(c in "0123456789" for c in m[0]) <= 15]
    return sorted(out, key=lambda s: (s[0], s[2]))


# --- the tagger -------------------------------------------------------------------------------------------------

#: Tags: outside, then for each kind its first and its other characters.
TAGS = 1 + 2 * len(KINDS)
SIGNS = "@.+-() _%:/,;\n\t'\"#*!?&=<>[]{}|\\$~^`"


def codes_of(text: str) -> np.ndarray:
    """Character classes: letters by themselves in lower case, signs by themselves, all digits as two classes, other
    letters, others; 0 is outside the text."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    table = np.full(129, 3, np.int64)
    table[128] = 4
    for c in range(128):
        if chr(c).isdigit():
            table[c] = 1 + (chr(c) in "01")
        elif chr(c).isalpha():
            table[c] = 5 + ord(chr(c).lower()) - 97
        elif chr(c) in SIGNS:
            table[c] = 31 + SIGNS.index(chr(c))
    return table[np.minimum(points, 128)]


CODES = 31 + len(SIGNS)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def initial_weights(seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    out = {"embed": rng.normal(0, 0.3, (CODES, EMBEDDING)), "out_w": rng.normal(0, 0.2, (2 * HIDDEN, TAGS)),
           "out_b": np.zeros(TAGS), "move": np.zeros((TAGS, TAGS)), "begin": np.zeros(TAGS)}
    for d in "fb":
        out[f"w{d}"] = rng.normal(0, 0.25, (EMBEDDING + HIDDEN, 4 * HIDDEN))
        out[f"b{d}"] = np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN)
    return out


def lstm(x: np.ndarray, w: np.ndarray, b: np.ndarray, keep: bool = True) -> tuple[np.ndarray, tuple]:
    """Hidden states (time, batch, hidden) of inputs (time, batch, embedding), and what the way back needs (`keep`)."""
    steps, batch, _ = x.shape
    inner = np.ascontiguousarray(w[EMBEDDING:])
    given = x @ w[:EMBEDDING] + b
    h, c = np.zeros((batch, HIDDEN)), np.zeros((batch, HIDDEN))
    out = np.empty((steps, batch, HIDDEN))
    gates, cells = (np.empty((steps, batch, k * HIDDEN)) if keep else [None] * steps for k in (4, 2))
    for t in range(steps):
        z = given[t]
        z += h @ inner
        g = np.tanh(z[:, 3 * HIDDEN:])
        s = sigmoid(z[:, :3 * HIDDEN])
        c = s[:, HIDDEN:2 * HIDDEN] * c + s[:, :HIDDEN] * g
        tc = np.tanh(c)
        h = np.multiply(s[:, 2 * HIDDEN:], tc, out=out[t])
        if keep:
            gates[t, :, :3 * HIDDEN], gates[t, :, 3 * HIDDEN:] = s, g
            cells[t, :, :HIDDEN], cells[t, :, HIDDEN:] = c, tc
    return out, (x, out, gates, cells)


def lstm_back(grad: np.ndarray, kept: tuple, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x, out, gates, cells = kept
    steps, batch, _ = grad.shape
    inner = np.ascontiguousarray(w[EMBEDDING:].T)
    i, f, o, g = (gates[:, :, k * HIDDEN:(k + 1) * HIDDEN] for k in range(4))
    tc = cells[:, :, HIDDEN:]
    before, last = np.zeros_like(tc), np.zeros_like(out)
    before[1:], last[1:] = cells[:-1, :, :HIDDEN], out[:-1]
    # What a step's gradient is multiplied by, for all steps at once: i, f and g by the cell's, o by the state's.
    by_cell = np.concatenate([g * i * (1 - i), before * f * (1 - f), i * (1 - g * g)], 2)
    by_state, cell = tc * o * (1 - o), o * (1 - tc * tc)
    dz = np.empty((steps, batch, 4 * HIDDEN))
    dh, dc = np.zeros((batch, HIDDEN)), np.zeros((batch, HIDDEN))
    for t in range(steps - 1, -1, -1):
        dh = dh + grad[t]
        dc = dc + dh * cell[t]
        own = np.concatenate([dc, dc, dc], 1) * by_cell[t]
        dz[t, :, :2 * HIDDEN], dz[t, :, 3 * HIDDEN:] = own[:, :2 * HIDDEN], own[:, 2 * HIDDEN:]
        np.multiply(dh, by_state[t], out=dz[t, :, 2 * HIDDEN:3 * HIDDEN])
        dh, dc = dz[t] @ inner, dc * f[t]
    flat = dz.reshape(-1, 4 * HIDDEN)
    joined = np.concatenate([x, last], 2).reshape(len(flat), -1)
    return dz @ w[:EMBEDDING].T, joined.T @ flat, flat.sum(0)


def emissions(w: dict[str, np.ndarray], codes: np.ndarray, keep: bool = True) -> tuple[np.ndarray, tuple]:
    """Scores (time, batch, tags) of windows (batch, time)."""
    x = w["embed"][codes.T]
    hf, kf = lstm(x, w["wf"], w["bf"], keep)
    hb, kb = lstm(x[::-1], w["wb"], w["bb"], keep)
    hidden = np.concatenate([hf, hb[::-1]], 2)
    return hidden @ w["out_w"] + w["out_b"], (hidden, kf, kb)


def powers_of(x: np.ndarray, axis=None) -> tuple[np.ndarray, np.ndarray]:
    """Exponentials relative to the largest, above what a double can hold, and the largest."""
    top = x.max(axis=axis, keepdims=axis is not None)
    return np.exp(np.maximum(x - top, -300)), top


def forward_backward(scores: np.ndarray, begin: np.ndarray, move: np.ndarray):
    """Log-partition (batch), tag marginals (time, batch, tags) and summed transition marginals; each step's sums are
    scaled to one."""
    steps = len(scores)
    (here, tops), (step, top) = powers_of(scores, 2), powers_of(move)
    first, first_top = powers_of(begin)
    alpha, beta, scale = np.empty_like(scores), np.ones_like(scores), np.empty((*scores.shape[:2], 1))
    for t in range(steps):
        a = np.multiply(alpha[t - 1] @ step if t else first, here[t], out=alpha[t])
        scale[t] = a.sum(1, keepdims=True)
        a /= scale[t]
    here /= scale
    back = step.T.copy()
    for t in range(steps - 2, -1, -1):
        beta[t] = (here[t + 1] * beta[t + 1]) @ back
    total = (np.log(scale) + tops).sum((0, 2)) + first_top + top * (steps - 1)
    after = (here[1:] * beta[1:]).reshape(-1, scores.shape[2])
    return total, alpha * beta, step * (alpha[:-1].reshape(len(after), -1).T @ after)


def fit(codes: np.ndarray, tags: np.ndarray) -> dict[str, np.ndarray]:
    """Weights by Adam on the conditional likelihood of the tags of windows (window, character)."""
    w = initial_weights()
    m, v = {k: 0.0 for k in w}, {k: 0.0 for k in w}
    rng = np.random.default_rng(11)
    for step in range(1, STEPS + 1):
        some = rng.integers(0, len(codes), BATCH)
        own, gold = codes[some], tags[some].T
        scores, (hidden, kf, kb) = emissions(w, own)
        _, marginal, moves = forward_backward(scores, w["begin"], w["move"])
        n = len(some)
        d = marginal / n
        steps, batch = np.indices(gold.shape)
        d[steps, batch, gold] -= 1 / n
        grads = {"out_w": np.einsum("tbh,tbk->hk", hidden, d), "out_b": d.sum((0, 1)), "begin": d[0].sum(0)}
        seen = np.zeros_like(moves)
        np.add.at(seen, (gold[:-1].ravel(), gold[1:].ravel()), 1)
        grads["move"] = (moves - seen) / n
        dh = d @ w["out_w"].T
        dxf, grads["wf"], grads["bf"] = lstm_back(dh[:, :, :HIDDEN], kf, w["wf"])
        dxb, grads["wb"], grads["bb"] = lstm_back(dh[::-1, :, HIDDEN:], kb, w["wb"])
        grads["embed"] = np.zeros_like(w["embed"])
        np.add.at(grads["embed"], own.T, dxf + dxb[::-1])
        for name, g in grads.items():
            g = np.clip(g, -1, 1)
            m[name] = 0.9 * m[name] + 0.1 * g
            v[name] = 0.99 * v[name] + 0.01 * g * g
            w[name] = w[name] - RATE * (m[name] / (1 - 0.9**step)) / (np.sqrt(v[name] / (1 - 0.99**step)) + 1e-8)
    return w


# --- windows ----------------------------------------------------------------------------------------------------

def stretches(text: str) -> list[tuple[int, int]]:
    """(first window, number of windows) of runs of neighbouring windows that hold a digit or an `@`."""
    hit = sorted({k for m in TRIGGER.finditer(text) for k in (m.start() // STEP - 1, m.start() // STEP) if k >= 0})
    out: list[tuple[int, int]] = []
    for k in hit:
        if out and out[-1][0] + out[-1][1] == k:
            out[-1] = (out[-1][0], out[-1][1] + 1)
        else:
            out.append((k, 1))
    return out


def window_codes(text: str, runs: list[tuple[int, int]]) -> np.ndarray:
    codes = np.concatenate([codes_of(text), np.zeros(WINDOW, np.int64)])
    return np.array([codes[k * STEP:k * STEP + WINDOW] for first, n in runs for k in range(first, first + n)]
                    ).reshape(-1, WINDOW)


def tags_of(n: int, spans: list[tuple[int, int, int]]) -> np.ndarray:
    tags = np.zeros(n, np.int64)
    for a, b, kind in spans:
        if not tags[a:b].any():
            tags[a] = 1 + 2 * kind
            tags[a + 1:b] = 2 + 2 * kind
    return tags


def decode(scores: list[np.ndarray], w: dict[str, np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """Of each sequence (time, tags), longest first, the spans of its best tags whose characters are all sure."""
    lengths = np.array([len(s) for s in scores])
    steps, n = int(lengths[0]), len(scores)
    padded = np.zeros((steps, n, TAGS))
    for k, s in enumerate(scores):
        padded[:len(s), k] = s
    running = np.searchsorted(-lengths, -np.arange(1, steps + 1), side="right")  # sequences that reach a step
    alpha, beta, back = np.zeros_like(padded), np.ones_like(padded), np.zeros(padded.shape, np.uint8)
    here, step = powers_of(padded, 2)[0], powers_of(w["move"])[0]
    best, final = w["begin"] + padded[0], np.empty(n, np.int64)
    for t in range(steps):
        m, after = running[t], running[t + 1] if t + 1 < steps else 0
        np.multiply(alpha[t - 1, :m] @ step if t else powers_of(w["begin"])[0], here[t, :m], out=alpha[t, :m])
        scale = alpha[t, :m].sum(1, keepdims=True)
        alpha[t, :m] /= scale
        here[t, :m] /= scale
        if t:
            ways = best[:m, :, None] + w["move"]
            back[t, :m] = ways.argmax(1)
            best[:m] = ways.max(1) + padded[t, :m]
        final[after:m] = best[after:m].argmax(1)
    tags = np.zeros((steps, n), np.int64)
    for t in range(steps - 1, -1, -1):
        m, after = running[t], running[t + 1] if t + 1 < steps else 0
        tags[t, after:m] = final[after:m]
        if after:
            ahead = tags[t + 1, :after]
            tags[t, :after] = back[t + 1, np.arange(after), ahead]
            beta[t, :after] = (here[t + 1, :after] * beta[t + 1, :after]) @ step.T
    sure = np.take_along_axis(alpha * beta, tags[:, :, None], 2)[:, :, 0] >= SURE
    out: list[list[tuple[int, int, int]]] = []
    for k, length in enumerate(lengths):
        spans: list[list[int]] = []
        for t in np.flatnonzero(tags[:length, k]).tolist():
            kind, first = divmod(int(tags[t, k]) - 1, 2)
            if first and spans and spans[-1][1] == t and spans[-1][2] == kind:
                spans[-1][1] = t + 1
            else:
                spans.append([t, t + 1, kind])
        out.append([(a, b, kind) for a, b, kind in spans if sure[a:b, k].all()])
    return out


def plausible(text: str, start: int, end: int, kind: int) -> bool:
    """Whether a span has what its kind is made of, whatever stands between."""
    own = text[start:end]
    if len(own) > SPAN_CHARS:
        return False
    if kind == 0:
        return bool(SHAPE.fullmatch(own))
    numbers = NUMBER.findall(own)
    digits = "".join(numbers)
    if not digits or NUMBER.match(text[max(start - 1, 0):start]) or NUMBER.match(text[end:end + 1]):
        return False
    if kind == 1:
        return len(numbers) == 4 and all(len(x) <= 3 and int(x) <= 255 for x in numbers)
    if kind == 2:
        return 12 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15


def parts_of(texts: list[str]) -> Iterator[tuple[int, int, int, int, int]]:
    """Of the stretches of all texts, cut where they are long: text, first window, windows, and the characters between
    which spans begin that the part gives."""
    for i, text in enumerate(texts):
        for first, n in stretches(text):
            for at in range(0, n, LONG):
                low, high = max(0, at - MARGIN), min(n, at + LONG + MARGIN)
                begin = (first + at) * STEP if at else 0
                end = (first + at + LONG) * STEP if at + LONG < n else len(text)
                yield i, first + low, high - low, begin, end


def tagger_spans(texts: list[str], w: dict[str, np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """Spans that the tagger finds in each text."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    held: list[tuple] = []
    for part in parts_of(texts):
        held.append(part)
        if sum(p[2] for p in held) * STEP >= DECODED_AT_ONCE:
            spans_of(texts, held, w, out)
            held = []
    if held:
        spans_of(texts, held, w, out)
    for found in out:  # spans that begin inside another, at the border of two parts
        found.sort()
        found[:] = [s for k, s in enumerate(found) if not k or s[0] >= found[k - 1][1]]
    return out


def spans_of(texts: list[str], parts: list[tuple], w: dict[str, np.ndarray], out: list[list[tuple]]) -> None:
    """Adds to `out` the spans of parts that are decoded side by side."""
    parts = sorted(parts, key=lambda p: -p[2])
    flat = np.concatenate([window_codes(texts[i][first * STEP:(first + n) * STEP + WINDOW], [(0, n)])
                           for i, first, n, *_ in parts])
    weight = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1))[:, None].astype(float)
    scores = np.empty((len(flat), WINDOW, TAGS))
    for k in range(0, len(flat), 512):
        scores[k:k + 512] = emissions(w, flat[k:k + 512], keep=False)[0].transpose(1, 0, 2)
    scores *= weight
    sequences, at = [], 0
    for i, first, n, *_ in parts:
        total, shares = np.zeros(((n + 1) * STEP, TAGS)), np.zeros(((n + 1) * STEP, 1))
        for half in range(WINDOW // STEP):  # windows overlap by half
            rows = slice(half * STEP, half * STEP + n * STEP)
            total[rows] += scores[at:at + n, half * STEP:(half + 1) * STEP].reshape(n * STEP, TAGS)
            shares[rows] += np.tile(weight[half * STEP:(half + 1) * STEP], (n, 1))
        sequences.append((total / shares)[:len(texts[i]) - first * STEP])
        at += n
    order = sorted(range(len(parts)), key=lambda k: -len(sequences[k]))
    while order:
        side = max(1, DECODED_AT_ONCE // len(sequences[order[0]]))
        now, order = order[:side], order[side:]
        for k, found in zip(now, decode([sequences[k] for k in now], w)):
            i, first, _, begin, end = parts[k]
            for a, b, kind in found:
                a, b = a + first * STEP, b + first * STEP
                if begin <= a < end and plausible(texts[i], a, b, kind):
                    out[i].append((a, b, kind))


def joined_spans(base: list[tuple[int, int, int]], more: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """All base spans, and those others that touch none of them."""
    extra = [s for s in more if all(s[1] <= b[0] or b[1] <= s[0] for b in base)]
    return sorted(base + extra, key=lambda s: (s[0], s[2]))


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each stretch of spans replaced by the name of its first kind."""
    out, at, end = [], 0, 0
    for a, b, kind in spans:
        if a >= end:
            out += [text[at:a], f"<{KINDS[kind].upper()}>"]
        at = end = max(end, b)
    return "".join([*out, text[at:]])


# Ways of writing that the patterns miss, and numbers that are no personal data. `#` is a digit.
FORMS = {
    "at": [" (at) ", "(at)", " [at] ", "[at]", " @ ", " AT ", "{at}", " at "],
    "dot": [" dot ", " (dot) ", "[dot]", " DOT ", " . "],
    "ip": ["[.]", " . ", "(.)", " dot ", "-", " [.] ", ", "],
    "card": [".", "/", "_", "  ", "\n", " - ", "\t", ":"],
    "phone": ["(###) ###-####", "###-###-####", "###.###.####", "### ### ####", "001 ### ### ####", "1-###-###-####",
              "+ 1 ### ### ####", "+1/###/###/####", "+1 ###\n###-####", "0### / #######", "00## (0)## #######",
              "+## ### ###\n###"],
}
PLAIN = ["20##-0#-1#", "1#.0#.19##", "0#/1#/20##", "1#:4#:3#", "20##-0#-1#T1#:5#:0#", "v#.#.##", "Version #.0", "#.#####",
         "$#,###.##", "## ### ###", "19##-20##", "pp. ###-###", "ISBN 978-#-##-######-#", "#" * 24, "####", "1#,###,###",
         "##%", "No. #####", "##x##", "RFC ####", "a##f#e##c##d#b##", "##-##", "(##)", "#.# . #.#", "##.##.##", "#,##,##",
         "at ##.##", "order ########", "#" * 17]


def digits_in(form: str, draw: random.Random) -> str:
    return "".join(draw.choice("0123456789") if c == "#" else c for c in form)


def invented(kind: int, draw: random.Random, words: list[str]) -> str:
    """Personal data of a kind in a way of writing that the patterns miss."""
    if kind == 0:
        name = draw.choice(words) + draw.choice(["", ".", "_", "-"]) + draw.choice([draw.choice(words), digits_in("##", draw)])
        at, dot = draw.choice(FORMS["at"]), draw.choice(FORMS["dot"])
        if at.strip("[({") != at and draw.random() < 0.4:
            dot = "."
        ending = draw.choice(["com", "org", "net", "de", "fr", "example.com", "co.uk", "es"])
        return name + at + draw.choice(words) + draw.choice(["", digits_in("#", draw)]) + dot + ending.replace(".", dot)
    if kind == 1:
        return draw.choice(FORMS["ip"]).join(str(draw.randrange(256)) for _ in range(4))
    if kind == 2:
        cuts = draw.choice([(4, 4, 4, 4), (4, 4, 4, 4), (4, 6, 5), (4, 4, 4, 1)])
        body = digits_in("#" * (sum(cuts) - 1), draw)
        digits = next(body + c for c in "0123456789" if luhn(body + c))
        ends = [sum(cuts[:k + 1]) for k in range(len(cuts))]
        return draw.choice(FORMS["card"]).join(digits[e - c:e] for e, c in zip(ends, cuts))
    return digits_in(draw.choice(FORMS["phone"]), draw)


def example(text: str, draw: random.Random) -> tuple[str, list[tuple[int, int, int]]]:
    """A text with personal data and plain numbers put between its words, and all its spans."""
    words = re.findall(r"(?a)[A-Za-z]{2,12}", text) or ["mail", "info"]
    gaps = [m.end() for m in re.finditer(r"\s+", text)]
    out, spans, size, last = [], [], 0, 0
    for gap in sorted(draw.sample(gaps, min(INSERTS, len(gaps)))):
        kind = draw.randrange(2 * len(KINDS) - 1)
        own = invented(kind, draw, words) if kind < len(KINDS) else digits_in(draw.choice(PLAIN), draw)
        out += [text[last:gap], own, draw.choice([" ", " ", ". ", ", ", "\n"])]
        size += gap - last
        if kind < len(KINDS):
            spans.append((size, size + len(own), kind))
        size, last = size + len(own) + len(out[-1]), gap
    text = "".join([*out, text[last:]])
    return text, joined_spans(spans, pattern_spans(text))


def train(docs: DataFrame) -> dict[str, np.ndarray] | None:
    """The tagger, from documents drawn by a hash of their text."""
    some = docs.where(F.length("text") > 0).select(F.xxhash64("text").alias("h"), "text")
    total = some.count()
    if not total:
        return None
    drawn = some.where(F.pmod("h", F.lit(1_000_000_000)) < int(2e9 * SAMPLE_DOCS / total) + 1)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Windows with their tags; nothing else of a text comes to the driver."""
        for batch in batches:
            rows = []
            for h, text in zip(batch.column("h").to_pylist(), batch.column("text").to_pylist()):
                text, spans = example(text, random.Random(h))
                runs = stretches(text)
                codes = window_codes(text, runs).astype(np.uint8)
                tags = np.concatenate([tags_of(len(text), spans), np.zeros(WINDOW, np.int64)])
                first = [k * STEP for a, n in runs for k in range(a, a + n)]
                rows += [(h, i, c.tobytes(), tags[a:a + WINDOW].astype(np.uint8).tobytes())
                         for i, (a, c) in enumerate(zip(first, codes))]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(
                (pa.int64(), pa.int32(), pa.binary(), pa.binary()))], names=["h", "i", "codes", "tags"])

    rows = (drawn.mapInArrow(cut, "h long, i int, codes binary, tags binary").distinct()
            .orderBy(F.xxhash64("h", "i"), "h", "i").limit(SAMPLE_WINDOWS).collect())
    if not rows or not any(any(r.tags) for r in rows):
        return None
    codes, tags = (np.array([np.frombuffer(r[c], np.uint8) for r in rows], np.int64) for c in ("codes", "tags"))
    return fit(codes, tags)


def redact(docs: DataFrame) -> DataFrame:
    """The rows with the spans of their text redacted; all other columns as they are."""
    weights = docs.sparkSession.sparkContext.broadcast(train(docs.select("text")))
    names = docs.columns

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                texts = part.column("text").to_pylist()
                more = tagger_spans([t or "" for t in texts], weights.value) if weights.value else [[]] * len(texts)
                out = [t and redacted(t, joined_spans(pattern_spans(t), m)) for t, m in zip(texts, more)]
                columns = [pa.array(out, pa.string()) if n == "text" else part.column(n) for n in names]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(rewrite, docs.schema)


def find(docs: DataFrame, *, redact: bool = False) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added and, if asked for, the redacted text."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    weights = docs.sparkSession.sparkContext.broadcast(train(docs))
    counts = [f"n_{k}" for k in KINDS]

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                texts = part.column("text").to_pylist()
                base = [pattern_spans(t) for t in texts]
                more = tagger_spans(texts, weights.value) if weights.value else [[]] * len(texts)
                spans = [joined_spans(b, m) for b, m in zip(base, more)]
                out = {"doc_id": part.column("doc_id")}
                for k, name in enumerate(counts):
                    out[name] = pa.array([sum(s[2] == k for s in b) for b in base], pa.int64())
                out["base_sha256"] = pa.array([hashlib.sha256(written(b).encode()).hexdigest() for b in base])
                out["spans"] = pa.array([written(s) for s in spans], pa.string())
                out["n_added"] = pa.array([len(s) - len(b) for s, b in zip(spans, base)], pa.int64())
                if redact:
                    out["redacted"] = pa.array([redacted(t, s) for t, s in zip(texts, spans)], pa.string())
                yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    kinds = ", ".join(f"{c} long" for c in counts)
    return docs.mapInArrow(tag, f"doc_id long, {kinds}, base_sha256 string, spans string, n_added long"
                           + (", redacted string" if redact else ""))
