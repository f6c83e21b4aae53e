"""SQL text of iterative fits, unrolled: Newton steps, Lloyd steps and tree levels become
chains of common table expressions over the cells of the data."""

from __future__ import annotations

from collections.abc import Sequence

from catalogue.inputs import key_sql


def solve(src: str, p: int, rhs: Sequence[str]) -> str:
    """Query that adds ``x_<r><i>``, the solution of the symmetric system in columns h<i><j>
    (i <= j) for each right side in columns <r><i>, by elimination."""
    q = f"(SELECT * FROM {src})"
    for j in range(p - 1):
        new = []
        for i in range(j + 1, p):
            new += [f"h{i}{k} - h{j}{i} * h{j}{k} / h{j}{j} AS h{i}{k}" for k in range(i, p)]
            new += [f"{r}{i} - h{j}{i} * {r}{j} / h{j}{j} AS {r}{i}" for r in rhs]
        q = f"(SELECT * REPLACE ({', '.join(new)}) FROM {q})"
    for i in range(p - 1, -1, -1):
        add = []
        for r in rhs:
            tail = "".join(f" - h{i}{k} * x_{r}{k}" for k in range(i + 1, p))
            add.append(f"({r}{i}{tail}) / h{i}{i} AS x_{r}{i}")
        q = f"(SELECT *, {', '.join(add)} FROM {q})"
    return q


def logit(name: str, cells: str, p: int, ridge: float = 0.0, group: str | None = None, steps: int = 12) -> list[str]:
    """CTEs ending in ``<name>``: coefficients b0..b<p-1>, variances v0.., and ``dev`` of the
    logistic fit of s successes in n trials on columns x1..x<p-1> of ``cells``."""
    x = ["1.0", *[f"x{i}" for i in range(1, p)]]
    g, on = (f"{group}, ", f"JOIN {{b}} USING ({group})") if group else ("", ", {b}")
    tail = f" GROUP BY {group}" if group else ""
    zero = ", ".join(f"0.0::DOUBLE AS b{i}" for i in range(p))
    ctes = [f"{name}_0 AS (SELECT {'DISTINCT ' + g if group else ''}{zero}" + (f" FROM {cells})" if group else ")")]
    eta = " + ".join(f"b{i} * {x[i]}" for i in range(p))
    keep = ", ".join(f"any_value(b{i}) AS b{i}" for i in range(p))
    h = ", ".join(f"sum(n * p * (1 - p) * {x[i]} * {x[j]}) AS h{i}{j}" for i in range(p) for j in range(i, p))
    score = ", ".join(f"sum((s - n * p) * {x[i]}) AS g{i}" for i in range(p))
    dev = "-2 * sum(s * ln(p) + (n - s) * ln(1 - p)) AS dev"
    pen = "" if not ridge else " REPLACE (" + ", ".join(
        [f"h{i}{i} + {ridge} AS h{i}{i}, g{i} - {ridge} * b{i} AS g{i}" for i in range(1, p)]
    ) + ")"
    units = [f"e{m}_" for m in range(p)]
    for k in range(steps + 1):
        source = f"(SELECT *, 1 / (1 + exp(-({eta}))) AS p FROM {cells} {on.format(b=f'{name}_{k}')})"
        ctes.append(f"{name}_s{k} AS (SELECT * {pen} FROM (SELECT {g}{keep}, {h}, {score}, {dev} FROM {source}{tail}))")
        if k < steps:
            moved = ", ".join(f"b{i} + x_g{i} AS b{i}" for i in range(p))
            ctes.append(f"{name}_{k + 1} AS (SELECT {g}{moved} FROM {solve(f'{name}_s{k}', p, ['g'])})")
    unit_cols = ", ".join(f"{1.0 if i == m else 0.0}::DOUBLE AS e{m}_{i}" for m in range(p) for i in range(p))
    last = f"(SELECT *, {unit_cols} FROM {name}_s{steps})"
    out = ", ".join(f"b{i}, x_e{i}_{i} AS v{i}" for i in range(p))
    ctes.append(f"{name} AS (SELECT {g}{out}, dev FROM {solve(last, p, units)})")
    return ctes


def lloyd(name: str, points: str, ks: Sequence[int], seed: int = 25, steps: int = 10, weight: str = "1") -> list[str]:
    """CTEs ending in ``<name>_c`` (k, c, ctr) and ``<name>_a`` (k, id, c, gap) for k-means on
    the list column v of ``points`` (id, v), started at the rows of lowest hash; a point counts
    ``weight`` times."""
    text = "array_to_string(list_transform(v, lambda z: round(z * 1e6)::BIGINT), ',')"
    k_values = ", ".join(f"({k})" for k in ks)
    ctes = [
        f"{name}_r AS (SELECT v, row_number() OVER (ORDER BY md5({key_sql([text])} || ':{seed}')) AS c FROM (SELECT DISTINCT v FROM {points}))",
        f"{name}_c0 AS (SELECT k, c, v AS ctr FROM {name}_r, (VALUES {k_values}) t(k) WHERE c <= k)",
    ]
    gap = "list_sum(list_transform(list_zip(v, ctr), lambda z: (z[1] - z[2]) ** 2))"

    def assign(i: int) -> str:
        return (
            f"{name}_a{i} AS MATERIALIZED (SELECT k, id, c, gap FROM (SELECT k, id, c, {gap} AS gap FROM {points}, {name}_c{i}) "
            "QUALIFY row_number() OVER (PARTITION BY k, id ORDER BY gap, c) = 1)"
        )

    for i in range(steps):
        ctes.append(assign(i))
        ctes.append(
            f"{name}_c{i + 1} AS MATERIALIZED (SELECT k, c, list(m ORDER BY d) AS ctr FROM (SELECT k, c, d, sum(x * w) / sum(w) AS m FROM "
            f"(SELECT k, c, {weight} AS w, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM {name}_a{i} JOIN {points} USING (id)) "
            "GROUP BY k, c, d) GROUP BY k, c)"
        )
    ctes += [assign(steps), f"{name}_c AS (SELECT * FROM {name}_c{steps})", f"{name}_a AS (SELECT * FROM {name}_a{steps})"]
    return ctes


SIDE = "CASE WHEN CASE f {cases} END <= t THEN 0 ELSE 1 END"


class TreeSql:
    """Boosted trees over ``cells`` (features, y, n): a chain of CTEs whose last one, ``rows``,
    holds the cells with their margin m, and whose ``splits`` list one (round, step, f, v, gain)
    each.  ``weight`` is the count column that training uses."""

    def __init__(self, name: str, cells: str, features: Sequence[str], weight: str = "n"):
        self.name, self.features, self.weight = name, list(features), weight
        self.ctes: list[str] = []
        self.rows = cells
        self.rounds = 0
        self.round_ctes: list[dict] = []

    def _add(self, tag: str, body: str) -> str:
        label = f"{self.name}_{tag}"
        self.ctes.append(f"{label} AS MATERIALIZED ({body})")
        return label

    def start(self, base: str) -> None:
        self.rows = self._add("m0", f"SELECT *, {base} AS m FROM {self.rows}")

    def _candidates(self, rows: str, gain: str, valid: str) -> str:
        """Query of all splits (node, f, v, gain) of all nodes."""
        stacked = " UNION ALL ".join(
            f"SELECT node, {i} AS f, {c} AS t, a, b FROM {rows} WHERE {self.weight} > 0" for i, c in enumerate(self.features)
        )
        return (
            "SELECT *, coalesce((t + nt) / 2, t) AS mid FROM (SELECT node, f, t, nt, la, lb, ta - la AS ra, tb - lb AS rb, ta, tb, "
            f"{gain} AS gain FROM (SELECT node, f, t, sum(a) OVER w AS la, sum(b) OVER w AS lb, "
            "sum(a) OVER (PARTITION BY node, f) AS ta, sum(b) OVER (PARTITION BY node, f) AS tb, lead(t) OVER w AS nt "
            f"FROM (SELECT node, f, t, sum(a) AS a, sum(b) AS b FROM ({stacked}) GROUP BY node, f, t) "
            f"WINDOW w AS (PARTITION BY node, f ORDER BY t)) WHERE nt IS NOT NULL) WHERE {valid}"
        )

    def _side(self) -> str:
        return SIDE.format(cases=" ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(self.features)))

    def level_round(self, a: str, b: str, gain: str, valid: str, depth: int, leaf: str, move: str = "m + leaf") -> None:
        """One round of a tree grown level by level."""
        r = self.rounds = self.rounds + 1
        rows = self._add(f"r{r}", f"SELECT *, {a} AS a, {b} AS b, 0 AS node FROM {self.rows}")
        levels = []
        for d in range(depth):
            cand = self._add(f"r{r}c{d}", self._candidates(rows, gain, valid))
            best = self._add(
                f"r{r}b{d}",
                f"SELECT * FROM (SELECT *, max(gain) OVER (PARTITION BY node) AS top FROM {cand}) WHERE gain >= top - 1e-10 * abs(top) "
                "QUALIFY row_number() OVER (PARTITION BY node ORDER BY f, t) = 1",
            )
            levels.append(best)
            rows = self._add(
                f"r{r}n{d}",
                f"SELECT x.* REPLACE (CASE WHEN s.f IS NULL THEN node ELSE 2 * node + 1 + {self._side()} END AS node) "
                f"FROM {rows} x LEFT JOIN (SELECT node, f, t FROM {best}) s USING (node)",
            )
        self._finish(rows, leaf, move, levels)

    def best_first_round(self, a: str, b: str, gain: str, valid: str, leaves: int, leaf: str, move: str = "m + leaf") -> None:
        """One round of a tree that always splits the node of greatest gain."""
        r = self.rounds = self.rounds + 1
        rows = self._add(f"r{r}", f"SELECT *, {a} AS a, {b} AS b, 0 AS node FROM {self.rows}")
        picks = []
        for step in range(1, leaves):
            cand = self._add(f"r{r}c{step}", self._candidates(rows, gain, valid))
            best = self._add(
                f"r{r}b{step}",
                f"SELECT * FROM (SELECT *, max(gain) OVER () AS top FROM {cand}) WHERE gain >= top - 1e-10 * abs(top) "
                "QUALIFY row_number() OVER (ORDER BY node, f, t) = 1",
            )
            picks.append(best)
            rows = self._add(
                f"r{r}n{step}",
                f"SELECT x.* REPLACE (CASE WHEN s.f IS NULL THEN node ELSE {2 * step - 1} + {self._side()} END AS node) "
                f"FROM {rows} x LEFT JOIN (SELECT node, f, t FROM {best}) s USING (node)",
            )
        self._finish(rows, leaf, move, picks)

    def _finish(self, rows: str, leaf: str, move: str, splits: list[str]) -> None:
        r = self.rounds
        w = self.weight
        leafs = self._add(
            f"r{r}l",
            f"SELECT *, {leaf} AS leaf FROM (SELECT node, sum(a) AS ga, sum(b) AS gb, least(sum(a), sum(b)) AS miss FROM {rows} WHERE {w} > 0 GROUP BY node)",
        )
        stats = self._add(
            f"r{r}t", f"SELECT sum(ga + gb) AS total, sum(miss) / sum(ga + gb) AS err FROM {leafs}"
        )
        self.rows = self._add(
            f"m{r}", f"SELECT x.* EXCLUDE (a, b, node) REPLACE ({move} AS m) FROM {rows} x JOIN {leafs} USING (node), {stats}"
        )
        self.round_ctes.append({"splits": splits, "leaves": leafs, "stats": stats})


NEWTON_A, NEWTON_B = "{n} * (1 / (1 + exp(-m)) - y)", "{n} * (1 / (1 + exp(-m))) * (1 - 1 / (1 + exp(-m)))"
GINI_GAIN = (
    "2 * ta * tb / (ta + tb) - 2 * la * lb / (la + lb) - 2 * (ta - la) * (tb - lb) / (ta - la + tb - lb)"
)
GINI_VALID = "la + lb > 0 AND ra + rb > 0 AND ta > 0 AND tb > 0"
CLIP = "greatest({v} / (ga + gb), 2.220446049250313e-16)"
HALF_LOG_ODDS = f"(ln({CLIP.format(v='gb')}) - ln({CLIP.format(v='ga')})) / 2"


def newton_trees(
    name: str, cells: str, features, rounds: int, depth: int, eta=0.3, lam=1.0, mcw=1.0, weight: str = "n"
) -> TreeSql:
    t = TreeSql(name, cells, features, weight)
    t.start(f"(SELECT 4 * (sum(y * {weight}) / sum({weight}) - 0.5) FROM {cells})")
    gain = f"la ** 2 / (lb + {lam}) + (ta - la) ** 2 / (tb - lb + {lam}) - ta ** 2 / (tb + {lam})"
    valid = f"lb >= {mcw} AND rb >= {mcw} AND gain > 1e-6"
    for _ in range(rounds):
        t.level_round(
            NEWTON_A.format(n=weight), NEWTON_B.format(n=weight), gain, valid, depth, f"-{eta} * ga / (gb + {lam})"
        )
    return t


def ada_trees(
    name: str, cells: str, features, rounds: int, rate=1.0, leaves: int | None = None, variant="samme.r", weight: str = "n"
) -> TreeSql:
    t = TreeSql(name, cells, features, weight)
    t.start("0.0::DOUBLE")
    shrink = rate if variant == "samme.r" else 0.5
    w = f"{weight} * exp(-{shrink} * (2 * y - 1) * m)"
    a, b = f"CASE WHEN y = 0 THEN {w} ELSE 0 END", f"CASE WHEN y = 1 THEN {w} ELSE 0 END"
    if variant == "samme.r":
        leaf, move = HALF_LOG_ODDS, "m + leaf"
    else:
        leaf, move = "CASE WHEN gb > ga THEN 1 ELSE -1 END", f"m + leaf * {rate} * ln((1 - err) / err)"
    for _ in range(rounds):
        if leaves:
            t.best_first_round(a, b, GINI_GAIN, GINI_VALID, leaves, leaf, move)
        else:
            t.level_round(a, b, GINI_GAIN, GINI_VALID, 1, leaf, move)
    return t
