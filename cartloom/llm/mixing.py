"""Mixing to target weights with soft domain membership.

1. Texts become a few binned measures (one projection).
2. A naive Bayes classifier over the bins is fitted on all labelled rows, by counting: it gives
   every text posteriors over the domains of the label table.
3. Texts of equal bins have equal posteriors, so they are summed to cells of tokens.
4. Rates ``0 <= rate <= most``, if bounded, are fitted to the targets by least squares, with a slight
   pull to the present (rate 1):
   ``sum_k (tokens_k(rate) - target_k)^2 / (2 tokens_k(1)) + PULL / 2 * sum_cells tokens (rate - 1)^2``,
   where ``tokens_k`` is the expected number of tokens of domain k. At the solution every rate is
   the projection of ``1 + p . step`` onto its bounds, with one number per domain in ``step``. Each
   round is one distributed sum over the cells: the misses and the normal matrix of the cells
   inside their bounds, by which the gradient is scaled (projected Newton). Some ten rounds end at
   the solution; only a few numbers per pair of domains reach the driver.
5. A text's rate becomes whole copies by a hash of its id.

All of it is DataFrame code; a text is read once and never shuffled.

Edge cases: null and empty texts have no tokens and the bins of an empty text; labels that are
null, or of unknown rows, are left out; without labels every text has one domain and rate 1;
repeated rows get equal rates and copies; a very long text is one row of measures like any other;
an empty table has no rows; other columns may have any name.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.llm.tables import WORD_GAP, Scratch, whole_text

#: Measures as SQL over the prepared columns, and the upper edges of their bins.
MEASURES = {
    "length": ("n_words", (0, 9, 19, 49, 99, 499, 1999)),
    "symbols": ("n_symbols / greatest(n_words, 1)", (0.01, 0.1, 0.5)),
    "capitals": ("n_capitals / greatest(n_words, 1)", (0.0, 0.3, 1.0, 2.5)),
    "marks": ("n_marks / greatest(n_words, 1)", (0.05, 0.3, 0.8)),
    "digits": ("n_digits / greatest(n_words, 1)", (0.0, 0.2, 1.0)),
    "distinct": ("n_distinct / greatest(n_words, 1)", (0.05, 0.2, 0.4, 0.55)),
    "spanish": ("n_spanish / greatest(n_words, 1)", (0.0, 0.05)),
    "german": ("n_german / greatest(n_words, 1)", (0.0, 0.05)),
    "french": ("n_french / greatest(n_words, 1)", (0.0, 0.05)),
}


#: The fit ends when the gradient by domain is this small beside its tokens, or cannot get smaller.
CLOSE, PULL = 1e-6, 1e-5


@dataclass(frozen=True)
class Targets:
    """``weights``: share of ``budget`` tokens by domain (budget None: their present tokens), or
    ``factors``: wanted tokens by domain as a multiple of the present ones. Others keep theirs.

    With ``by_text`` the factor of its likeliest domain holds for a text, and the targets are the
    expected tokens that this leaves: rates between the least and the greatest factor reach them.
    """

    weights: dict[str, float] = field(default_factory=dict)
    budget: int | None = None
    factors: dict[str, float] = field(default_factory=dict)
    by_text: bool = False

    def of(self, present: dict[str, float]) -> dict[str, float]:
        total = sum(self.weights.values())
        budget = self.budget or sum(tokens for k, tokens in present.items() if k in self.weights)
        out = {}
        for k, tokens in present.items():
            if k in self.weights:
                out[k] = budget * self.weights[k] / total
            else:
                out[k] = tokens * self.factors.get(k, 1.0)
        return out


def binned(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """All columns of ``docs`` in ``row``, with ``id``, ``tokens`` (words) and ``bins``."""
    texts = docs.select(F.struct("*").alias("row"), F.col(id_column).alias("id"), whole_text(text_column).alias("txt"))
    parts = texts.select(
        "row",
        "id",
        F.expr("regexp_replace(txt, '[a-z\\\\s.,]+', '')").alias("odd"),
        F.filter(F.split("txt", WORD_GAP), lambda w: w != "").alias("words"),
    )
    odd = "length(regexp_replace(odd, '[^{}]+', ''))"
    counted = parts.select(
        "row",
        "id",
        F.size("words").alias("n_words"),
        F.size(F.array_distinct("words")).alias("n_distinct"),
        F.expr(odd.format("#*$%&|<>")).alias("n_symbols"),
        F.expr(odd.format("A-Z")).alias("n_capitals"),
        F.expr(odd.format("!?;:()-")).alias("n_marks"),
        F.expr(odd.format("0-9")).alias("n_digits"),
        F.expr(odd.format("ñóíáúÑ")).alias("n_spanish"),
        F.expr(odd.format("ßüäöÜÄÖ")).alias("n_german"),
        F.expr(odd.format("èêçàÈÊÇÀ")).alias("n_french"),
    )
    place = lambda e, edges: " + ".join(f"cast({e} > {x} as int)" for x in edges)
    measured = counted.withColumns({f"m_{m}": F.expr(e) for m, (e, _) in MEASURES.items()})
    bins = "concat(" + ", ".join(f"cast({place('m_' + m, edges)} as string)" for m, (_, edges) in MEASURES.items()) + ")"
    return measured.select("row", "id", F.col("n_words").cast("long").alias("tokens"), F.expr(bins).alias("bins"))


def _classifier(cells: DataFrame, labelled: DataFrame) -> list[tuple[str, float, list[list[float]]]]:
    """Per domain: name, log prior, log likelihood by measure and bin. Counts only: bounded rows."""
    counts = labelled.groupBy("domain", "bins").count()
    each = counts.select(
        "domain", "count", F.expr(f"posexplode(array({', '.join(f'substring(bins, {i + 1}, 1)' for i in range(len(MEASURES)))}))").alias("m", "bin")
    )
    tallied = each.groupBy("domain", "m", "bin").agg(F.sum("count").alias("n")).collect()
    domains = sorted({r["domain"] for r in tallied}) or ["all"]
    table = {(r["domain"], r["m"], int(r["bin"])): r["n"] for r in tallied}
    size = {d: sum(table.get((d, 0, b), 0) for b in range(10)) for d in domains}
    total, out = sum(size.values()), []
    for d in domains:
        rows = []
        for m, (_, edges) in enumerate(MEASURES.values()):
            k = len(edges) + 1
            rows.append([math.log((table.get((d, m, b), 0) + 0.1) / (size[d] + 0.1 * k)) for b in range(k)])
        out.append((d, math.log((size[d] + 1) / (total + len(domains))), rows))
    return out


def _posteriors(model) -> str:
    """SQL array of the posteriors, from ``bins``."""
    scores = []
    for _, prior, rows in model:
        terms = [f"element_at(array({', '.join(f'{x:.9f}d' for x in r)}), cast(substring(bins, {m + 1}, 1) as int) + 1)" for m, r in enumerate(rows)]
        scores.append(f"{prior:.9f}d + " + " + ".join(terms))
    return "array(" + ", ".join(scores) + ")"


def solve(matrix: list[list[float]], right: list[float]) -> list[float]:
    """The solution of a small positive definite system, by elimination."""
    rows = [[*row, x] for row, x in zip(matrix, right, strict=True)]
    n = len(rows)
    for i in range(n):
        pivot = max(range(i, n), key=lambda k: abs(rows[k][i]))
        rows[i], rows[pivot] = rows[pivot], rows[i]
        for k in range(i + 1, n):
            factor = rows[k][i] / rows[i][i]
            rows[k] = [x - factor * y for x, y in zip(rows[k], rows[i], strict=True)]
    out = [0.0] * n
    for i in reversed(range(n)):
        out[i] = (rows[i][n] - sum(rows[i][k] * out[k] for k in range(i + 1, n))) / rows[i][i]
    return out


def fit_rates(
    cells: DataFrame, domains: list[str], targets: Targets, most: float | None, rounds: int
) -> tuple[DataFrame, dict[str, float]]:
    """Adds ``rate`` to cells of (bins, tokens, p); and the miss left by domain, relative to its target."""
    n = len(domains)
    pairs = [(i, j) for i in range(n) for j in range(i, n)]

    def raised(step: list[float]) -> str:
        return "1d + " + " + ".join(f"p[{k}] * {x!r}d" for k, x in enumerate(step))

    def bounded(step: list[float]) -> str:
        rate = f"greatest(0d, {raised(step)})"
        return rate if most is None else f"least({most!r}d, {rate})"

    def sums(rate: str, free: str = "false", value: str = "0d") -> tuple[list[float], list[list[float]], float]:
        """Expected tokens by domain, the normal matrix of the free cells, and the sum of a value of each token."""
        held = cells.selectExpr("tokens", "p", f"{rate} as rate", f"if({free}, cast(tokens as double), 0d) as open_tokens", f"{value} as value")
        row = held.agg(
            *[F.expr(f"sum(tokens * rate * p[{k}])") for k in range(n)],
            *[F.expr(f"sum(open_tokens * p[{i}] * p[{j}])") for i, j in pairs],
            F.expr("sum(tokens * value)"),
        ).first()
        values = [float(x or 0) for x in row]
        matrix = [[0.0] * n for _ in range(n)]
        for (i, j), x in zip(pairs, values[n:-1], strict=True):
            matrix[i][j] = matrix[j][i] = x
        return values[:n], matrix, values[-1]

    def at(step: list[float]) -> tuple[list[float], list[list[float]], list[float], float]:
        """Tokens, normal matrix and gradient of the convex function of the step whose least value is sought, and that value."""
        # Cells on a bound count as free, as the next step may move them.
        up, rate = f"({raised(step)})", bounded(step)
        inside = f"{up} >= 0" + ("" if most is None else f" and {up} <= {most!r}d")
        have, matrix, value = sums(rate, inside, f"({rate}) * ({up} - ({rate}) / 2)")
        g = [h - w + PULL * s * x for h, w, s, x in zip(have, wanted, scale, step, strict=True)]
        value += sum(x * (PULL * s * x / 2 - w) for x, s, w in zip(step, scale, wanted, strict=True))
        return have, matrix, g, value

    present = sums("1d")[0]
    scale = [max(x, 1.0) for x in present]
    if targets.by_text:
        factors = ", ".join(f"{float(targets.factors.get(d, 1.0))!r}d" for d in domains)
        wanted = sums(f"element_at(array({factors}), cast(array_position(p, array_max(p)) as int))")[0]
    else:
        target = targets.of(dict(zip(domains, present, strict=True)))
        wanted = [target[d] for d in domains]

    step = [0.0] * n
    have, matrix, g, value = at(step)
    for _ in range(rounds):
        if math.sqrt(sum((x / s) ** 2 for x, s in zip(g, scale, strict=True))) <= CLOSE:
            break
        for i in range(n):
            matrix[i][i] += PULL * scale[i]
        change, length = solve(matrix, g), 1.0
        fall = sum(x * c for x, c in zip(g, change, strict=True))
        while length > 1e-6:
            tried = [x - length * c for x, c in zip(step, change, strict=True)]
            have, matrix, g, there = at(tried)
            if there <= value - 1e-4 * length * fall:
                break
            length /= 4
        else:  # no digits left to gain
            have = at(step)[0]
            break
        step, value = tried, there
    miss = {d: (h - w) / max(w, 1.0) for d, h, w in zip(domains, have, wanted, strict=True)}
    return cells.withColumn("rate", F.expr(bounded(step))), miss


def mix_sources(
    docs: DataFrame,
    labels: DataFrame,
    targets: Targets,
    id_column: str = "doc_id",
    text_column: str = "text",
    domain: str = "concat(lang, case when quality > 0 then '' else '-junk' end)",
    most: float | None = None,
    rounds: int = 40,
    with_rows: bool = False,
) -> DataFrame:
    """(id, n_tokens, domain, posterior, rate, copies, miss) per document row, and the row if asked.

    ``domain`` is a SQL expression over the columns of documents and labels: the label of a
    labelled row. ``most`` bounds the rates; with 1 no row is repeated, and without it every
    domain with tokens can grow to its target. ``miss`` is what the fit leaves between the expected
    tokens of the row's domain and their target, relative to the target: not near 0 where the
    target is out of reach.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    given = binned(docs, id_column, text_column)
    narrow = scratch.keep(
        given.select(F.struct(*[F.col(f"row.`{c}`") for c in docs.columns if c != text_column]).alias("row"), "id", "tokens", "bins")
    )
    labels = labels.where(F.col(id_column).isNotNull()).dropDuplicates([id_column])
    marks = [c for c in labels.columns if c != id_column]
    # The documents' columns keep their names, whatever they are; where both have one, the labels' counts.
    held = [c for c in docs.columns if c not in (text_column, id_column, *marks)]
    known = narrow.select(F.col("id").alias("_mix_id"), F.col("bins").alias("_mix_bins"), *[F.col(f"row.`{c}`") for c in held])
    marked = labels.select(F.col(id_column).alias("_mix_label_id"), *marks)
    labelled = known.join(marked, F.expr("_mix_id = _mix_label_id")).select(F.col("_mix_bins").alias("bins"), F.expr(domain).alias("domain"))
    cells = narrow.groupBy("bins").agg(F.sum("tokens").alias("tokens"))
    model = _classifier(cells, labelled.where("domain is not null"))
    names = [d for d, _, _ in model]
    scored = cells.withColumn("score", F.expr(_posteriors(model))).withColumn("odds", F.expr("transform(score, s -> exp(s - array_max(score)))"))
    cells = scratch.keep(
        scored.select("bins", "tokens", F.expr("transform(odds, o -> o / aggregate(odds, 0d, (a, x) -> a + x))").alias("p"))
    )
    rates, miss = fit_rates(cells, names, targets, most, rounds)
    table = rates.select("bins", F.expr(f"element_at(array({', '.join(repr(n) for n in names)}), cast(array_position(p, array_max(p)) as int))").alias("domain"), F.col("p").alias("posterior"), "rate")
    source = given if with_rows else narrow.select("id", "tokens", "bins")
    draw = "pmod(xxhash64(id, 17), 1000000) / 1000000d"
    return source.join(table, "bins").select(
        *(["row"] if with_rows else []),
        F.col("id").alias(id_column),
        F.col("tokens").alias("n_tokens"),
        "domain",
        "posterior",
        "rate",
        F.expr(f"cast(floor(rate + {draw}) as int)").alias("copies"),
        F.expr("case domain " + " ".join(f"when {n!r} then {miss[n]!r}d" for n in names) + " end").alias("miss"),
    )
