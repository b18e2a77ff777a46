"""Language identification with interpolated Kneser-Ney character models.

One model of order ``ORDER`` for each language, trained on a bounded sample of
labelled texts (``CHARS_PER_LANGUAGE`` expected characters a language, drawn by
a hash of the row).  All models lie side by side in sorted arrays of n-gram
hashes, one array an order, with a column of log probabilities a language, the
lower orders already mixed in; contexts have a sorted array of their back-off
weights.  The language of the lowest cross-entropy per character wins, and a
text whose cross-entropy is out of line with that of labelled texts of the
language is rejected: the limit is fitted on a quarter of the sample that the
models have not seen, with a spread that narrows with the text's length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.llm.codes import SPACE, char_table, find, gram_hashes, hash_rows, normalise, pieces
from salescope.llm.common import keep, release, ship

ORDER = 5
#: Bound of the labelled sample: expected characters a language.
CHARS_PER_LANGUAGE = 4_000_000
#: Bound of the label set (a model column each).
MAX_LANGUAGES = 500
#: Standard deviations above the expected cross-entropy at which a text is rejected.
REJECT_AT = 6.0
#: Characters after which the evidence for the winner counts as full.
FULL_EVIDENCE = 100
UNDECIDED = "und"


@dataclass
class LanguageModels:
    languages: list[str]
    table: np.ndarray
    keys: list[np.ndarray] = field(default_factory=list)
    logs: list[np.ndarray] = field(default_factory=list)
    contexts: list[np.ndarray] = field(default_factory=list)
    backoff: list[np.ndarray] = field(default_factory=list)
    unseen: np.ndarray | None = None
    limits: np.ndarray | None = None  # mean, spread at any length, spread of one character

    def gram_logs(self, hashes: list[np.ndarray], at: np.ndarray) -> np.ndarray:
        """Natural log probabilities (places x languages) of the codes at ``at``."""
        order = len(self.keys)
        total = np.zeros((len(at), len(self.languages)), np.float32)
        open_ = np.arange(len(at))
        for k in range(order, 0, -1):
            place, hit = find(self.keys[k - 1], hashes[k - 1][at[open_]])
            total[open_[hit]] += self.logs[k - 1][place[hit]]
            open_ = open_[~hit]
            if not len(open_):
                return total
            if k > 1:
                place, hit = find(self.contexts[k - 1], hashes[k - 2][at[open_] - 1])
                total[open_[hit]] += self.backoff[k - 1][place[hit]]
        total[open_] += self.unseen
        return total

    def cross_entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: summed -log2 by language, characters counted, letters."""
        n, pad = len(texts), len(self.keys) - 1
        bits = np.zeros((n, len(self.languages)))
        chars, letters = np.zeros(n, np.int64), np.zeros(n, np.int64)
        history, spaced = np.full(pad, SPACE, np.uint32), True
        for idx, parts, goes_on in pieces([t or "" for t in texts]):
            if not goes_on:
                history, spaced = np.full(pad, SPACE, np.uint32), True
            codes, _, lengths = normalise(parts, self.table, spaced)
            # each text is preceded by its history: spaces, or the piece before
            at = np.arange(len(codes)) + np.repeat((np.arange(len(parts)) + 1) * pad, lengths)
            line = np.full(len(codes) + pad * len(parts), SPACE, np.uint32)
            line[at] = codes
            if len(parts) == 1:
                line[:pad] = history
                history = line[len(line) - pad:].copy()
                spaced = bool(history[-1] == SPACE) if len(codes) or goes_on else True
            hashes = gram_hashes(line, pad + 1)
            sums = np.zeros((len(codes) + 1, len(self.languages)))
            for a in range(0, len(at), 1 << 16):
                sums[a + 1:a + 1 + (1 << 16)] = self.gram_logs(hashes, at[a:a + (1 << 16)])
            sums = np.cumsum(sums, axis=0, out=sums)
            ends = np.cumsum(lengths)
            bits[idx] -= (sums[ends] - sums[ends - lengths]) / np.log(2)
            chars[idx] += lengths
            known = np.concatenate([[0], np.cumsum(codes != SPACE)])
            letters[idx] += known[ends] - known[ends - lengths]
        return bits, chars, letters

    def predict(self, texts: list[str | None]) -> pd.DataFrame:
        n = len(texts)
        out = pd.DataFrame({"lang_pred": [UNDECIDED] * n, "score": np.zeros(n), "cross_entropy": np.full(n, np.nan),
                            "accepted": np.zeros(n, bool)})
        if not self.languages or not n:
            return out
        bits, chars, letters = self.cross_entropies(texts)
        mean = bits / np.maximum(chars, 1)[:, None]
        best = mean.argmin(axis=1)
        low = mean.min(axis=1)
        evidence = np.exp2(-(mean - low[:, None]) * np.minimum(chars, FULL_EVIDENCE)[:, None])
        ok = letters > 0
        centre, wide, one = self.limits[:, best]
        limit = centre + REJECT_AT * np.sqrt(wide + one / np.maximum(chars, 1))
        out["lang_pred"] = np.where(ok, np.array(self.languages, object)[best], UNDECIDED)
        out["score"] = np.where(ok, 1 / evidence.sum(axis=1), 0.0)
        out["cross_entropy"] = np.where(ok, low, np.nan)
        out["accepted"] = ok & (low <= limit)
        return out


def _discount(counts: np.ndarray) -> float:
    once, twice = int((counts == 1).sum()), int((counts == 2).sum())
    return once / (once + 2 * twice) if once and twice else 0.5


def kneser_ney(languages: list[str], grams: np.ndarray, lang: np.ndarray, counts: np.ndarray,
               table: np.ndarray) -> LanguageModels:
    """Models from the highest order's n-grams: ``grams`` (rows of codes,
    oldest first), the language number and the count of each."""
    order, width = grams.shape[1], len(languages)
    model = LanguageModels(languages, table)
    by_order = [(grams, lang, counts)]
    for k in range(order - 1, 0, -1):  # continuation counts: different codes before the suffix
        rows, of, _ = by_order[-1]
        joint, n = np.unique(np.column_stack([of.astype(np.uint32), rows[:, 1:]]), axis=0, return_counts=True)
        by_order.append((joint[:, 1:], joint[:, 0].astype(np.int64), n))
    lower = alphabet = None
    for k, (rows, of, n) in enumerate(reversed(by_order), 1):
        hashes = hash_rows(rows)
        keys, first, place = np.unique(hashes, return_index=True, return_inverse=True)
        unique = rows[first]
        context_hash = hash_rows(rows[:, :-1])
        contexts, context_of = np.unique(context_hash, return_inverse=True)
        discounts = np.array([_discount(n[of == x]) for x in range(width)])
        total = np.zeros((len(contexts), width))
        kinds = np.zeros((len(contexts), width))
        np.add.at(total, (context_of, of), n)
        np.add.at(kinds, (context_of, of), 1)
        seen = total > 0
        weight = np.where(seen, discounts * kinds / np.maximum(total, 1), 1.0)
        direct = np.zeros((len(keys), width))
        direct[place, of] = np.maximum(n - discounts[of], 0) / total[context_of, of]
        weight_of_key = weight[context_of[first]]
        if k == 1:
            alphabet = len(keys) + 1
            lower_of = np.full((len(keys), width), 1 / alphabet)
            model.unseen = np.log(np.maximum(weight[0], 1e-6) / alphabet).astype(np.float32)
        else:
            at, _ = find(model.keys[-1], hash_rows(unique[:, 1:]))
            lower_of = lower[at]
        lower = direct + weight_of_key * lower_of
        model.keys.append(keys)
        model.logs.append(np.log(np.maximum(lower, 1e-12)).astype(np.float32))
        model.contexts.append(contexts)
        model.backoff.append(np.log(np.maximum(weight, 1e-6)).astype(np.float32))
    return model


def fit_languages(labelled: DataFrame, order: int = ORDER, chars: int = CHARS_PER_LANGUAGE) -> LanguageModels:
    """Models of the languages in ``labelled`` (``text``, ``lang``; rows with a
    null in either teach nothing).  No labelled row: no language."""
    spark = labelled.sparkSession
    rows = labelled.select("text", "lang").where("text is not null and lang is not null")
    sizes = rows.groupBy("lang").agg(F.sum(F.length("text")).alias("n")).limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    table = char_table(digits=False)
    languages = sorted(r.lang for r in sizes if r.n)
    if not languages:
        return LanguageModels([], table)
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r.lang, min(1.0, chars / max(r.n or 1, 1)))])
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / float(1 << 30)
    sample = keep(rows.where(draw < F.element_at(share, F.col("lang"))).withColumn(
        "fold", F.pmod(F.xxhash64(F.lit("fold"), "text"), F.lit(4))), "language-sample")
    number = {x: i for i, x in enumerate(languages)}
    sent = spark.sparkContext.broadcast(table)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lang, texts in b.groupby("lang")["text"]:
                for _, parts, _ in pieces(list(texts)):
                    codes, _, lengths = normalise(parts, sent.value)
                    pad = order - 1
                    at = np.arange(len(codes)) + np.repeat((np.arange(len(parts)) + 1) * pad, lengths)
                    line = np.full(len(codes) + pad * len(parts), SPACE, np.uint32)
                    line[at] = codes
                    hashes = gram_hashes(line, order)[-1][at]
                    _, first, n = np.unique(hashes, return_index=True, return_counts=True)
                    rows = np.column_stack([line[at[first] - j] for j in range(pad, -1, -1)])
                    grams = rows.astype("<u4").tobytes().decode("utf-32-le")
                    yield pd.DataFrame({"lang": number[lang], "n": n, "gram": [
                        grams[i:i + order] for i in range(0, len(grams), order)]})

    found = (sample.where("fold <> 0").select("text", "lang")
             .mapInPandas(count, "lang int, n long, gram string")
             .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas())
    if not len(found):
        release(sample)
        return LanguageModels([], table)
    found = found.sort_values(["lang", "gram"])
    grams = np.frombuffer("".join(found["gram"]).encode("utf-32-le"), np.uint32).reshape(-1, order)
    model = kneser_ney(languages, grams, found["lang"].to_numpy(np.int64), found["n"].to_numpy(np.int64), table)
    model.limits = np.array([[0.0] * len(languages)] * 3)
    unlimited = spark.sparkContext.broadcast(model)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            bits, n, _ = unlimited.value.cross_entropies(list(b["text"]))
            own = bits[np.arange(len(b)), [number[x] for x in b["lang"]]]
            yield pd.DataFrame({"lang": [number[x] for x in b["lang"]], "n": n, "bits": own})

    measured = sample.where("fold = 0").select("text", "lang").mapInPandas(
        measure, "lang int, n long, bits double").where("n > 0").toPandas()
    for x in range(len(languages)):
        m = measured[measured["lang"] == x]
        mean = m["bits"] / m["n"]
        if len(m) < 8:  # too few to tell: nothing is rejected
            model.limits[:, x] = 0.0, np.inf, 0.0
            continue
        centre = float(mean.mean())
        # squared distances as a line in 1 / length, neither part below zero
        d, inv = (mean - centre) ** 2, 1 / m["n"]
        one = max(0.0, float(np.cov(d, inv, bias=True)[0, 1] / max(inv.var(ddof=0), 1e-18)))
        wide = max(1e-4, float(d.mean() - one * inv.mean()))
        model.limits[:, x] = centre, wide, max(one, 1e-2)
    release(sample)
    return model


def identify(docs: DataFrame, model: LanguageModels, out: str = "language") -> DataFrame:
    """``docs`` with a struct ``out`` (lang_pred, score, cross_entropy,
    accepted) in place of a column of this name.

    Null texts and texts without a letter: ``und``, score 0, not accepted.
    The whole text counts; only ``text`` is read.  Ties go to the language
    first in code-point order.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def column(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            yield sent.value.predict([t if isinstance(t, str) else None for t in s])

    column.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    kind = "lang_pred string, score double, cross_entropy double, accepted boolean"
    return docs.withColumn(out, F.pandas_udf(column, kind)(F.col("text")))


ship(__name__)
