"""Personal data in whole texts: fixed patterns, and a linear-chain CRF for what they leave.

Fixed patterns give the base spans. The CRF labels the words around digits and
at-signs with the kinds of the patterns. A word without either is outside in
every labelling, in training as in use, so a text falls apart into short chains
that are decoded on their own, exactly. What the CRF finds beyond the base spans, in
another way of writing, is added as spans of the same kinds if it keeps the
checks of its kind (a card's check digit, a phone's length); base spans stay as
they are.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import slices

# Kinds in their order, and the patterns of the contract.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = "%+-._" + "".join(map(chr, [*range(48, 58), *range(65, 91), *range(97, 123)]))
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_MARK = re.compile(r"[0-9@]")

Span = tuple[int, int, int]


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) of the fixed patterns, by kind, then start. Linear in the text's length.

    An address is found from its at-sign: the local part is the run before it,
    and no shorter start can match where the run's does not.
    """
    spans: list[Span] = []
    at, floor, done = text.find("@"), 0, 0
    while at >= 0:
        before = text[max(floor, done) : at]
        start = at - (len(before) - len(before.rstrip(_LOCAL)))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            spans.append((0, start, domain.end()))
            done = domain.end()
        floor = at + 1
        at = text.find("@", max(floor, done))
    if not _MARK.search(text):
        return spans
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            spans.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "") if len(m[0]) <= 40 else ""
        if 13 <= len(digits) <= 19 and _luhn(digits):
            spans.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
            spans.append((3, m.start(), m.end()))
    return spans


def chains(text: str) -> list[list[tuple[int, int]]]:
    """Runs of words that hold a digit or an at-sign, as (start, end)."""
    out: list[list[tuple[int, int]]] = []
    at, last = _MARK.search(text), -1
    while at:
        start = at.start()
        while start > max(last, 0) and text[start - 1] not in " \t\n\v\f\r":
            start -= 1
        end = _WORD.match(text, at.start()).end()
        if out and last >= 0 and not _WORD.search(text, last, start):
            out[-1].append((start, end))
        else:
            out.append([(start, end)])
        last = end
        at = _MARK.search(text, end)
    return out


def shape(word: str) -> str:
    """Digits as d, letters as x or X, other characters as they are; runs shortened to one."""
    plain = re.sub(r"[0-9]+", "d", re.sub(r"[^\W\d_]+", lambda m: "X" if m[0][0].isupper() else "x", word))
    return re.sub(r"(.)\1+", r"\1", plain)


def features(text: str, chain: list[tuple[int, int]]) -> list[list[str]]:
    """Features of each word of a chain: its shape, digits and marks, and the shapes beside it."""
    words = [text[a:b] for a, b in chain]
    shapes = ["", *map(shape, words), ""]
    out = []
    for k, word in enumerate(words, 1):
        digits = sum(c in "0123456789" for c in word)
        core = word.strip(".,;:!?()[]{}<>\"'#*$%&|")
        out.append([
            "w=" + shapes[k], "c=" + shape(core), f"d={min(digits, 20)}", f"l={min(len(word), 80) // 4}", "b=" + word[0] if not word[0].isalnum() else "b=",
            "p=" + shapes[k - 1], "n=" + shapes[k + 1], "pc=" + shapes[k - 1] + "|" + shapes[k], "cn=" + shapes[k] + "|" + shapes[k + 1],
        ])
    return out


class Crf:
    """Weights of a linear chain: label 0 is outside, then two labels per kind, its first word and the others."""

    LABELS = 1 + 2 * len(KINDS)

    def __init__(self, names: dict[str, int], emit: np.ndarray, move: np.ndarray):
        self.names, self.emit, self.move = names, emit, move

    def scores(self, rows: list[list[str]]) -> np.ndarray:
        return np.stack([self.emit[[self.names[f] for f in row if f in self.names]].sum(0) for row in rows])

    def decode(self, emitted: list[np.ndarray], batch: int = 4096) -> list[np.ndarray]:
        """Viterbi paths, in batches of chains of like length."""
        paths: list[np.ndarray] = [np.empty(0, np.int64)] * len(emitted)
        order = sorted(range(len(emitted)), key=lambda i: len(emitted[i]))
        first = 0
        while first < len(order):
            longest = len(emitted[order[min(first + batch, len(order)) - 1]])
            some = order[first : first + max(1, min(batch, 2_000_000 // (longest * self.LABELS)))]
            first += len(some)
            lengths = np.array([len(emitted[i]) for i in some])
            grid = np.zeros((len(some), lengths.max(), self.LABELS))
            for r, i in enumerate(some):
                grid[r, : lengths[r]] = emitted[i]
            back = np.zeros(grid.shape, np.int8)
            best = grid[:, 0] + self.move[0]
            for t in range(1, grid.shape[1]):
                through = best[:, :, None] + self.move[None, :, :]
                back[:, t] = through.argmax(1)
                live = (t < lengths)[:, None]
                best = np.where(live, through.max(1) + grid[:, t], best)
            last = best.argmax(1)
            for r, i in enumerate(some):
                path = np.empty(lengths[r], np.int64)
                path[-1] = last[r]
                for t in range(lengths[r] - 1, 0, -1):
                    path[t - 1] = back[r, t, path[t]]
                paths[i] = path
        return paths


def train(table: list[tuple[list[list[str]], list[int]]], rounds: int = 60, decay: float = 1e-3) -> Crf:
    """Fit by gradient ascent on the log-likelihood (forward-backward over all chains at once).

    `table` holds chains: the features of each word, and its label. An empty
    table gives a model that labels everything outside.
    """
    k = Crf.LABELS
    names = {f: i for i, f in enumerate(sorted({f for rows, _ in table for row in rows for f in row}))}
    emit, move = np.zeros((len(names), k)), np.zeros((k, k))
    for y in range(2, k, 2):  # an inner word only follows its own kind
        move[[p for p in range(k) if p not in (y - 1, y)], y] = -1e4
    if not table:
        return Crf(names, emit, move)
    allowed = move == 0
    n, steps = len(table), max(len(labels) for _, labels in table)
    mask, gold = np.zeros((n, steps), bool), np.zeros((n, steps), np.int64)
    r, f, t = [], [], []
    for i, (rows, labels) in enumerate(table):
        mask[i, : len(labels)], gold[i, : len(labels)] = True, labels
        for j, row in enumerate(rows):
            r += [i] * len(row)
            t += [j] * len(row)
            f += [names[x] for x in row]
    r, t, f = np.array(r), np.array(t), np.array(f)
    want_emit, want_move = np.zeros_like(emit), np.zeros_like(move)
    np.add.at(want_emit, (f, gold[r, t]), 1)
    previous = np.concatenate([np.zeros((n, 1), np.int64), gold[:, :-1]], 1)
    np.add.at(want_move, (previous[mask], gold[mask]), 1)
    speed_e, speed_m = np.full_like(emit, 1e-8), np.full_like(move, 1e-8)
    for _ in range(rounds):
        grid = np.zeros((n, steps, k))
        np.add.at(grid, (r, t), emit[f])
        ahead, behind = np.zeros((n, steps, k)), np.zeros((n, steps, k))
        ahead[:, 0] = grid[:, 0] + move[0]
        for j in range(1, steps):
            ahead[:, j] = np.logaddexp.reduce(ahead[:, j - 1][:, :, None] + move, axis=1) + grid[:, j]
        for j in range(steps - 2, -1, -1):
            nxt = np.logaddexp.reduce(move[None] + (grid[:, j + 1] + behind[:, j + 1])[:, None, :], axis=2)
            behind[:, j] = np.where(mask[:, j + 1][:, None], nxt, 0)
        total = np.logaddexp.reduce(ahead[np.arange(n), mask.sum(1) - 1], axis=1)
        here = np.exp(ahead + behind - total[:, None, None]) * mask[:, :, None]
        got_emit, got_move = np.zeros_like(emit), np.zeros_like(move)
        np.add.at(got_emit, f, here[r, t])
        got_move[0] += here[:, 0].sum(0)
        for j in range(1, steps):
            both = ahead[:, j - 1][:, :, None] + move + (grid[:, j] + behind[:, j])[:, None, :] - total[:, None, None]
            got_move += (np.exp(both) * mask[:, j][:, None, None]).sum(0)
        up_e, up_m = want_emit - got_emit - decay * n * emit, (want_move - got_move) * allowed
        speed_e += up_e**2
        speed_m += up_m**2
        emit += 0.5 * up_e / np.sqrt(speed_e)
        move += 0.5 * up_m / np.sqrt(speed_m)
    return Crf(names, emit, move)


def labelled_chains(text: str) -> list[tuple[list[list[str]], list[int]]]:
    """The chains of a text, labelled by its base spans, and variants that the base patterns do not match.

    A variant is the same chain in another way of writing: a phone number without its plus
    sign, a card number in groups of four digits, an address with its at-sign in brackets.
    """
    out = []
    spans = base_spans(text)
    for chain in chains(text):
        own = [s for s in spans if s[1] < chain[-1][1] and s[2] > chain[0][0]]
        out.append((features(text, chain), _labels(chain, own)))
        for kind, a, b in own:
            piece = text[a:b]
            other = {0: piece.replace("@", "[@]"), 2: "-".join(re.findall("....?", piece)), 3: piece[1:]}.get(kind)
            if other and other != piece:
                moved = [(m.start(), m.end()) for m in _WORD.finditer(other) if _MARK.search(m[0])]
                out.append((features(other, moved), _labels(moved, [(kind, 0, len(other))])))
    return out


def _labels(chain: list[tuple[int, int]], spans: list[Span]) -> list[int]:
    labels, previous = [], None
    for a, b in chain:
        span = next((s for s in spans if s[1] < b and s[2] > a), None)
        labels.append(0 if span is None else 1 + 2 * span[0] + (span == previous))
        previous = span
    return labels


def _plausible(kind: int, piece: str) -> bool:
    """Whether a span keeps the checks of its kind, however it is written."""
    digits = re.findall("[0-9]+", piece)
    if kind == 0:
        name, _, place = piece.partition("@")
        return any(c.isalnum() for c in name) and "." in place.strip(".")
    if kind == 1:
        return len(digits) == 4 and all(len(d.lstrip("0")) <= 3 and int(d[-3:]) <= 255 for d in digits)
    if kind == 2:
        return 13 <= len("".join(digits)) <= 19 and _luhn("".join(digits))
    return 9 <= len("".join(digits)) <= 15


def found_spans(text: str, model: Crf, base: list[Span], parts: list[list[tuple[int, int]]], paths: list[np.ndarray]) -> list[Span]:
    """Base spans and the CRF's that touch none of them, by kind, then start."""
    starts = sorted((a, b) for _, a, b in base)
    added = []
    for chain, path in zip(parts, paths):
        for k, y in enumerate(path.tolist()):
            if y % 2:
                a, end = chain[k][0], k
                while end + 1 < len(path) and path[end + 1] == y + 1:
                    end += 1
                b = chain[end][1]
                piece = text[a:b]
                a, b = a + len(piece) - len(piece.lstrip(".,;:!?[]{}<>\"'#*$%&|")), b - (len(piece) - len(piece.rstrip(".,;:!?[]{}<>\"'#*$%&|")))
                if _plausible((y - 1) // 2, text[a:b]) and not any(a < e and s < b for s, e in starts):
                    added.append(((y - 1) // 2, a, b))
    return sorted([*base, *added])


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = 400, most: int = 4000, longest: int = 24) -> Crf:
    """A CRF trained on a small labelled table: at most `most` chains from at most `sample` documents.

    The documents are those with the smallest hash of their id, so the same
    table is drawn every time. Chains longer than `longest` words are not used
    for training (they are decoded like others).
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    few = rows.where("text RLIKE '[0-9@]'").select(F.xxhash64("id").alias("h"), "id").distinct().orderBy("h", "id").limit(sample)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            for h, text in zip(batch.column("h").to_pylist(), batch.column("text").to_pylist()):
                found = [(f, y) for f, y in labelled_chains(text) if len(y) <= longest][:most]
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([h] * len(found)), pa.array([f for f, _ in found]), pa.array([y for _, y in found], pa.list_(pa.int64()))],
                        ["h", "features", "labels"],
                    )

    chosen = rows.join(F.broadcast(few), rows["id"].eqNullSafe(few["id"])).select("h", "text").where("text IS NOT NULL")
    table = chosen.mapInArrow(label, "h long, features array<array<string>>, labels array<long>")
    got = table.orderBy("h", F.xxhash64("features"), F.xxhash64("labels")).limit(most).collect()
    return train([(r.features, r.labels) for r in got])


def find_pii(docs: DataFrame, model: Crf | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of `docs`: doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans.

    A null text is empty. Spans are code points, end exclusive. Repeated rows
    give repeated results; an empty table gives none. Other columns are ignored.
    """
    crf = model or fit(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            base = [base_spans(t) for t in texts]
            parts = [chains(t) for t in texts]
            flat = [crf.scores(features(t, c)) for t, cs in zip(texts, parts) for c in cs]
            paths = iter(crf.decode(flat))
            spans = [found_spans(t, crf, b, cs, [next(paths) for _ in cs]) for t, b, cs in zip(texts, base, parts)]
            counts = [pa.array([sum(s[0] == k for s in b) for b in base], pa.int64()) for k in range(len(KINDS))]
            sha = [hashlib.sha256(_joined(b).encode()).hexdigest() for b in base]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *counts, pa.array(sha), pa.array([_joined(s) for s in spans])],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string")
