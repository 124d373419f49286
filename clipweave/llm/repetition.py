"""Repetition inside a single document, and its outliers by robust covariance."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipweave.llm import codes
from clipweave.session import cut

#: A passage of so many words counts as repeated wherever it was said before.
PASSAGE = 4
#: The statistics, each a share between 0 and 1, by which documents are compared.
STATS = ("repeated", "passages", "echoes", "unvaried")
#: Rows of a group from which its own estimate is made; smaller groups share one.
LEAST_ROWS = 60
#: Rows of a group on which starts are tried, subsets of rows tried as starts, those followed to their end, and those
#: that are concentrated over all rows of the group.
START_ROWS = 2_000
STARTS, FOLLOWED, CARRIED = 60, 8, 2
#: Concentration over all rows ends when no determinant falls by this share any more, or after this many rounds.
SETTLED = 1e-3
MAX_ROUNDS = 30
#: Squared Mahalanobis distance beyond which a vector is rejected: the 0.999 quantile of chi square with four degrees of freedom.
CUTOFF = 18.467
#: Standard deviation, in transformed units, that is added to every direction: about that of a share of half a hundredth.
FLOOR = 0.06
#: Longest period for which a text is compared with itself letter by letter; longer ones are found by hashes.
SHORT_PERIOD = 64


def shares(texts: list[str]) -> np.ndarray:
    """STATS of every text, and its numbers of letters, of Arabic and of Latin ones, as columns.

    repeated: share of the letters in a passage already said before, PASSAGE words or more anywhere (passages) or
    anything that directly follows its own copy, with or without blanks between (echoes). unvaried: share of the words
    that are not the first of their kind. Tags, punctuation, case, vowel marks and characters without a glyph are
    ignored. A text without letters has zeros.
    """
    n = len(texts)
    w = codes.Words(texts)
    letters = np.bincount(w.char_text, minlength=n)[:n]
    out = np.zeros((n, len(STATS) + 3))
    arabic = (w.chars >= 0x0621) & (w.chars <= 0x06D3)
    latin = (w.chars >= ord("a")) & (w.chars <= ord("z"))
    for i, flag in ((4, None), (5, arabic), (6, latin)):
        out[:, i] = letters if flag is None else np.bincount(w.char_text[flag], minlength=n)[:n]
    if not len(w.chars):
        return out
    hashes = w.hashes()
    passage = np.zeros(len(w.chars) + 1, np.int32)
    grams = codes.runs_of(hashes, PASSAGE)
    if len(grams):
        inside = np.flatnonzero(w.text_of[: len(grams)] == w.text_of[PASSAGE - 1 :])
        again = _seen_before(codes.mix(grams[inside]) + w.text_of[inside].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        at = inside[again]
        np.add.at(passage, w.starts[at], 1)
        np.add.at(passage, w.starts[at + PASSAGE], -1)
    passage = np.cumsum(passage[:-1]) > 0
    echo = _echoes(w)
    words = np.diff(w.bounds)
    again = _seen_before(hashes + codes.mix(w.text_of.astype(np.uint64)))
    for i, flag in enumerate((passage | echo, passage, echo)):
        out[:, i] = np.bincount(w.char_text[flag], minlength=n)[:n] / np.maximum(letters, 1)
    out[:, 3] = np.bincount(w.text_of[again], minlength=n)[:n] / np.maximum(words, 1)
    return out


def _seen_before(x: np.ndarray) -> np.ndarray:
    """True where the same number stands further in front."""
    order = np.argsort(x, kind="stable")
    flag = np.zeros(len(x), bool)
    flag[order[1:]] = x[order[1:]] == x[order[:-1]]
    return flag


def _echoes(w: codes.Words) -> np.ndarray:
    """True for the letters in the second half of some square: a piece of fewer than PASSAGE words right after its copy.

    Texts are taken in classes by the longest piece they can hold, so short texts aren't searched for long pieces.
    """
    sizes = np.bincount(w.char_text)
    spans = w.starts[np.minimum(np.arange(len(w.starts) - 1) + PASSAGE, len(w.starts) - 1)] - w.starts[:-1]
    longest = np.zeros(len(sizes), np.int64)
    np.maximum.at(longest, w.text_of, spans)
    longest = np.minimum(longest, sizes // 2)
    flag = np.zeros(len(w.chars), bool)
    done, low, high = longest == 0, 0, 32
    for t in np.flatnonzero(longest > SHORT_PERIOD).tolist():
        at = np.flatnonzero(w.char_text == t)
        flag[at] |= _long_squares(w.chars[at], SHORT_PERIOD + 1, int(longest[t]))
    longest = np.minimum(longest, SHORT_PERIOD)
    while not done.all():
        members = ~done & (longest > low)
        if members.any():
            at = np.flatnonzero(members[w.char_text])
            flag[at] |= _squares(w.chars[at], w.char_text[at], low + 1, int(min(high, longest[members].max())))
        done |= longest <= high
        low, high = high, high * 2
    return flag


def _squares(chars: np.ndarray, text: np.ndarray, low: int, high: int) -> np.ndarray:
    """Letters in the second half of a square of period low..high within one text."""
    # A number of its own between texts, so that no run of matches as long as its period can cross a seam.
    n = len(chars)
    seams = np.flatnonzero(text[1:] != text[:-1]) + 1
    at = np.arange(n) + np.searchsorted(seams, np.arange(n), "right")
    s = np.full(n + len(seams), 0x80000000, np.uint32)
    holes = np.ones(len(s), bool)
    holes[at] = False
    s[at] = chars
    s[holes] = 0x80000000 + np.arange(len(seams), dtype=np.uint32)
    edges = np.zeros(len(s) + 1, np.int32)
    for p in range(low, high + 1):
        if 2 * p > len(s):
            break
        same = np.empty(len(s) - p + 2, np.int8)
        same[0] = same[-1] = 0
        np.equal(s[p:], s[:-p], out=same[1:-1].view(bool))
        turns = np.flatnonzero(same[1:] != same[:-1])
        first, last = turns[::2], turns[1::2]
        long = last - first >= p
        if long.any():
            np.add.at(edges, first[long] + p, 1)
            np.add.at(edges, last[long] + p, -1)
    return (np.cumsum(edges[:-1]) > 0)[at]


def _long_squares(s: np.ndarray, low: int, high: int, held: int = 2_000_000) -> np.ndarray:
    """Letters in the second half of a square of period low..high of one text, in about n log n steps.

    A square of period p holds two places p apart, the first a multiple of p, whose common stretch to both sides is at
    least p long. Only there are texts compared, by hashes of prefixes and a search by halves for the stretch's ends.
    """
    n = len(s)
    edges = np.zeros(n + 1, np.int32)
    with np.errstate(over="ignore"):
        base = np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)
        power = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, base, np.uint64))])
        prefix = np.concatenate([[np.uint64(0)], np.cumsum(codes.mix(s.astype(np.uint64) + np.uint64(1)) * power[:n])])

    def same(i: np.ndarray, p: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the stretches of a length at i and at i + p are the same."""
        with np.errstate(over="ignore"):
            return (prefix[i + length] - prefix[i]) * power[p] == prefix[i + p + length] - prefix[i + p]

    def furthest(most: np.ndarray, holds) -> np.ndarray:
        lo, hi = np.zeros(len(most), np.int64), most.copy()
        while (lo < hi).any():
            mid = (lo + hi + 1) // 2
            ok = holds(mid)
            lo, hi = np.where(ok, mid, lo), np.where(ok, hi, mid - 1)
        return lo

    periods = np.arange(low, min(high, n // 2) + 1)
    counts = np.maximum((n - 1) // periods, 1)
    upto = np.cumsum(counts)
    for k in range(0, int(upto[-1]) if len(upto) else 0, held):
        number = np.arange(k, min(k + held, int(upto[-1])))
        which = np.searchsorted(upto, number, "right")
        p = periods[which]
        i = (number - (upto[which] - counts[which])) * p
        ok = i + p < n
        i, p = i[ok], p[ok]
        ok = s[i] == s[i + p]
        i, p = i[ok], p[ok]
        # One of the two sides makes up half of the period.
        half = p // 2
        right = np.zeros(len(i), bool)
        fit = i + p + half <= n
        right[fit] = same(i[fit], p[fit], half[fit])
        left = np.zeros(len(i), bool)
        fit = i - half + 1 >= 0
        left[fit] = same(i[fit] - half[fit] + 1, p[fit], half[fit])
        i, p = i[right | left], p[right | left]
        ahead = furthest(np.minimum(p, n - i - p), lambda m: same(i, p, m))
        back = furthest(np.minimum(p - 1, i), lambda m: same(i - m, p, m))
        long = ahead + back >= p
        first, last = (i - back)[long], (i + ahead)[long]
        np.add.at(edges, first + p[long], 1)
        np.add.at(edges, last + p[long], -1)
    return np.cumsum(edges[:-1]) > 0


def repetition_stats(documents: DataFrame, *, key: str = "id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(`key`, *keep, *STATS, letters, arabic, latin) for every row; null text counts as empty. Whole texts are read.

    The last three count letters, Arabic letters and Latin letters, by which the language of a transcript is told.
    """
    schema = documents.select(key, *keep).schema
    spec = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + "".join(f", {s} double" for s in STATS) + ", letters bigint, arabic bigint, latin bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
            table = shares(texts)
            names = [f.name for f in schema]
            arrays = [batch.column(i) for i in range(len(names))]
            arrays += [pa.array(table[:, i]) for i in range(len(STATS))] + [pa.array(table[:, i].astype(np.int64)) for i in range(len(STATS), len(STATS) + 3)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, *STATS, "letters", "arabic", "latin"])

    return documents.select(key, *keep, F.col(text)).mapInArrow(run, spec)


def robust_outliers(vectors: DataFrame, columns: list[str], groups: list[str]) -> DataFrame:
    """`vectors` with d2, the squared Mahalanobis distance of the transformed `columns` to the robust centre of its group.

    Minimum covariance determinant as in FAST-MCD. Shares are transformed by the arc sine of their root, which evens out
    their spread. Many starts are tried on a bounded sample of each group and the best followed to their end; then the
    CARRIED best of every group are concentrated over all its rows until their determinants settle, all groups in the
    same passes: count by distance, keep the nearer half, take its mean and covariance. The start of least determinant
    wins, and its estimate is weighted once more with all rows inside the 0.975 quantile. Counts and moments are combined
    before the shuffle, so a group with a third of all rows is never gathered. The same is done for all rows together,
    under the empty name: groups under LEAST_ROWS are measured by that estimate, and so are groups whose centre is itself
    rejected by it, which most of their rows being broken can bring about. Column names that begin with an underscore are reserved.
    """
    dims = range(len(columns))
    group = F.concat_ws("\u0001", *[F.coalesce(F.col(g).cast("string"), F.lit("?")) for g in groups])
    x = [F.asin(F.sqrt(F.least(F.greatest(F.col(c), F.lit(0.0)), F.lit(1.0)))).alias(f"_x{i}") for i, c in enumerate(columns)]
    rows = cut(vectors.select("*", group.alias("_own"), *x), "mcd-rows")
    xs = [F.col(f"_x{i}") for i in dims]
    large = rows.groupBy("_own").agg(F.count("*").alias("_all")).where(F.col("_all") >= LEAST_ROWS)
    everything = rows.agg(F.count("*").alias("_all")).select(F.lit("").alias("_g"), "_all").where("_all > 0")
    totals = cut(large.select(F.col("_own").alias("_g"), "_all").unionByName(everything), "mcd-sizes")
    both = rows.select(F.col("_own").alias("_g"), *xs).unionByName(rows.select(F.lit("").alias("_g"), *xs))
    fitted = both.join(totals.select("_g"), "_g", "left_semi")
    scale = 1 << 30
    share = F.least(F.lit(1.0), F.lit(1.2 * START_ROWS) / F.col("_all"))
    sample = fitted.join(totals, "_g").where(F.pmod(F.xxhash64(*xs, F.rand(0)), F.lit(scale)) < share * scale).select("_g", *xs)
    fit_spec = "_g string, _s int, _m array<double>, _p array<double>, _det double"
    fit = cut(sample.groupBy("_g").applyInPandas(_starts, fit_spec), "mcd-fit")

    def moments(near: DataFrame) -> DataFrame:
        return near.groupBy("_g", "_s").agg(
            F.array(*[F.avg(c) for c in xs]).alias("_m"), F.array(*[F.avg(xs[i] * xs[j]) for i in dims for j in dims if i <= j]).alias("_c")
        )

    for _ in range(MAX_ROUNDS):
        # The median distance comes from counts in steps of two hundredths, which are cheap to combine.
        near = fitted.join(fit, "_g").withColumn("_d", F.floor(F.log(_distance(xs) + 1e-6) * 50))
        steps = near.groupBy("_g", "_s", "_d").agg(F.count("*").alias("_k"))
        own = Window.partitionBy("_g", "_s")
        placed_steps = steps.withColumns({"_u": F.sum("_k").over(own.orderBy("_d")), "_t": F.sum("_k").over(own)})
        edge = placed_steps.where(F.col("_u") * 2 >= F.col("_t") + len(columns) + 1).groupBy("_g", "_s").agg(F.min("_d").alias("_e"))
        kept = near.join(edge, ["_g", "_s"]).where(F.col("_d") <= F.col("_e"))
        moved = moments(kept).mapInPandas(_estimates(0.5), fit_spec)
        before = fit.select("_g", "_s", F.col("_det").alias("_old"))
        fit = cut(moved.join(before, ["_g", "_s"]), "mcd-fit")
        falling = fit.where(F.col("_det") < F.col("_old") * (1 - SETTLED)).limit(1).count()
        fit = fit.drop("_old")
        if not falling:
            break
    best = fit.groupBy("_g").agg(F.min_by(F.struct("_s", "_m", "_p"), F.struct("_det", "_s")).alias("_b")).select("_g", "_b.*")
    inner = fitted.join(best, "_g").where(_distance(xs) <= _chi_square(0.975, len(columns)))
    final = cut(moments(inner).mapInPandas(_estimates(0.975), fit_spec), "mcd-fit")
    common = final.where("_g = ''").first()  # one row of a few numbers
    if common is None:
        return vectors.select("*", F.lit(0.0).alias("d2"), F.lit(False).alias("above"))
    middle, inverse = (F.array(*[F.lit(float(v)) for v in common[c]]) for c in ("_m", "_p"))
    centre = final.where("_g <> ''").select("_g", F.col("_m").alias("_gm"), F.col("_p").alias("_gp"), middle.alias("_m"), inverse.alias("_p"))
    sound = centre.where(_distance([F.col("_gm")[i] for i in dims]) <= CUTOFF).select(F.col("_g").alias("_own"), "_gm", "_gp")
    used = rows.join(sound, "_own", "left").withColumns({"_m": F.coalesce("_gm", middle), "_p": F.coalesce("_gp", inverse)})
    return used.select(*vectors.columns, _distance(xs).alias("d2"), (F.col("_x0") > F.col("_m")[0]).alias("above"))


def _distance(xs: list[Column]) -> Column:
    n = len(xs)
    diff = [x - F.col("_m")[i] for i, x in enumerate(xs)]
    # The inverse is symmetric: each pair of unequal directions counts twice.
    return sum((diff[i] * diff[j] * F.col("_p")[i * n + j] * (1.0 if i == j else 2.0) for i in range(n) for j in range(i, n)), F.lit(0.0))


def _chi_square(share: float, degrees: int) -> float:
    """A quantile of chi square, by the cube-root approximation."""
    from statistics import NormalDist

    z = NormalDist().inv_cdf(share)
    return degrees * (1 - 2 / (9 * degrees) + z * (2 / (9 * degrees)) ** 0.5) ** 3


def _wide(cov: np.ndarray, share: float) -> np.ndarray:
    """The covariance of the inner `share` of the rows, scaled so that it stands for a normal body, and FLOOR wide at least."""
    from statistics import NormalDist

    n, q = len(cov), _chi_square(share, len(cov))
    inner = n + 2
    below = NormalDist().cdf(((q / inner) ** (1 / 3) - (1 - 2 / (9 * inner))) / (2 / (9 * inner)) ** 0.5)
    return cov * (share / below) + FLOOR**2 * np.eye(n)


def _estimates(share: float):
    """A function of groups' moments to their estimates: centre, inverse and determinant of the covariance."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            inverse, det = [], []
            for m, c in zip(b["_m"], b["_c"]):
                n = len(m)
                second = np.zeros((n, n))
                second[np.triu_indices(n)] = c
                wide = _wide(second + np.triu(second, 1).T - np.outer(m, m), share)
                inverse.append(np.linalg.inv(wide).ravel().tolist())
                det.append(float(np.linalg.det(wide)))
            yield pd.DataFrame({"_g": b["_g"], "_s": b["_s"], "_m": b["_m"], "_p": inverse, "_det": det})

    return run


def concentrated(x: np.ndarray, centre: np.ndarray, inverse: np.ndarray, rounds: int) -> tuple[float, np.ndarray, np.ndarray]:
    """(determinant, centre, inverse) after concentration steps, until the nearer half of the rows no longer changes."""
    half, last, det = (len(x) + x.shape[1] + 1) // 2, None, np.inf
    for _ in range(rounds):
        diff = x - centre
        near = np.sort(np.argsort(np.einsum("ij,jk,ik->i", diff, inverse, diff), kind="stable")[:half])
        if last is not None and np.array_equal(near, last):
            break
        last, centre = near, x[near].mean(axis=0)
        wide = _wide((x[near] - centre).T @ (x[near] - centre) / len(near), 0.5)
        inverse, det = np.linalg.inv(wide), float(np.linalg.det(wide))
    return det, centre, inverse


def _starts(pdf: pd.DataFrame) -> pd.DataFrame:
    """The CARRIED best estimates of a sample of one group: from its medians and from random subsets just large enough."""
    x = pdf.drop(columns="_g").to_numpy(float)
    x = x[np.lexsort(x.T)]  # the same whatever order the rows came in
    if len(x) > START_ROWS:
        x = x[np.linspace(0, len(x) - 1, START_ROWS).astype(int)]
    rng = np.random.default_rng(0)
    middle = np.median(x, axis=0)
    spread = np.maximum(1.4826 * np.median(np.abs(x - middle), axis=0), FLOOR)
    tried = [concentrated(x, middle, np.diag(1 / spread**2), 2)]
    for _ in range(STARTS):
        few = x[rng.choice(len(x), min(len(x), x.shape[1] + 1), replace=False)]
        centre = few.mean(axis=0)
        tried.append(concentrated(x, centre, np.linalg.inv(_wide((few - centre).T @ (few - centre) / len(few), 0.5)), 2))
    tried.sort(key=lambda t: t[0])
    ends: dict[float, tuple] = {}
    for det, centre, inverse in tried[:FOLLOWED]:
        end = concentrated(x, centre, inverse, 100)
        ends.setdefault(round(float(np.log(end[0])), 6), end)
    best = [ends[k] for k in sorted(ends)[:CARRIED]]
    return pd.DataFrame({
        "_g": pdf["_g"].iloc[0], "_s": np.arange(len(best), dtype=np.int32), "_m": [m.tolist() for _, m, _ in best],
        "_p": [p.ravel().tolist() for _, _, p in best], "_det": np.inf,
    })


def repetitive(documents: DataFrame, *, key: str = "id", text: str = "text", groups: tuple[str, ...] = ("source",)) -> DataFrame:
    """(`key`, *groups, language, *STATS, letters, d2, rejected) of every document.

    A document is rejected when its vector of repetition shares lies beyond CUTOFF from the robust centre of its
    language and source, on the side of more repetition. The language is told from the script: arabic, latin, mixed or
    none. `documents` has one row per `key`; null and empty texts have shares of 0 and are not rejected; an empty table
    gives an empty result; other columns are ignored.
    """
    stats = repetition_stats(documents, key=key, text=text, keep=groups)
    arabic, latin = F.col("arabic"), F.col("latin")
    language = F.when(arabic + latin == 0, "none").when(arabic >= 4 * latin, "arabic").when(latin >= 4 * arabic, "latin").otherwise("mixed")
    stats = stats.withColumn("language", language)
    scored = robust_outliers(stats, list(STATS), ["language", *groups])
    return scored.select(key, *groups, "language", *STATS, "letters", "d2", ((F.col("d2") > CUTOFF) & F.col("above")).alias("rejected"))
