"""Player score per position: rates, first principal component, 0-100 scale, four levels.

The component is computed from one small covariance row per position, so only aggregates and no player rows
leave the executors' partitions.
"""

from __future__ import annotations

import sys
from typing import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed, measures, text
from ..operators import aggregates, filters, ranking
from ..session import spread, stored

# Functions of this module go to the tasks as code, so that executors need not import it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RATES = {
    "goles_p90": (("goles",), 1),
    "asistencias_p90": (("asistencias",), 1),
    "participacion_p90": (("goles", "asistencias"), 1),
    "amarillas_p90": (("tarjetas_amarillas",), -1),
    "rojas_p90": (("tarjetas_rojas",), -1),
    "segunda_am_p90": (("tarjeta_amarilla_roja",), -1),
    "gc_p90": (("goles_en_contra",), -1),
    "pi_p90": (("partidos_imbatido",), 1),
}


def player_features(stats: DataFrame, squads: DataFrame, min_minutes: int = fixed.MIN_MINUTES) -> DataFrame:
    """Players with enough minutes, one profile row each, rates per 90 minutes and filled height.

    The profile of the player's own team is preferred, then the smallest squad key.
    """
    enough = filters.at_least(stats, "minutos_jugados", min_minutes)
    # The hashes of the rows travel as bytes, and squad rows move once, to the partition of their player and season: the first
    # profile of each of the player's teams there, listed in one row (as many as the player has teams in the season).
    person = ["id_jugador", "temporada"]
    rows = squads.select(text.packed_key("id_jugador").alias("id_jugador"), "temporada", F.col("id_equipo").alias("club"),
                         text.packed_key("id_plantilla_equipo").alias("at"), "pie", "altura", F.col("posicion").alias("_posicion"))
    first = F.struct(text.unpacked_key("at").alias("at"), "pie", "altura", "_posicion")
    each = rows.repartition(*person).groupBy(*person, "club").agg(F.min(first).alias("p"))
    profile = each.groupBy(*person).agg(F.min("p").alias("_other"), F.collect_list(F.struct("club", "p")).alias("_teams"))
    hashes = [c for c in ("id_jugador", "id_estadistica_jugador") if c in enough.columns]
    joined = enough.withColumns({c: text.packed_key(c) for c in hashes}).join(profile, person, "left")
    joined = joined.withColumn("_own", F.get(F.filter("_teams", lambda t: t["club"] == F.col("id_equipo")), F.lit(0))["p"])
    for c in ("pie", "altura", "_posicion"):
        joined = joined.withColumn(c, F.when(F.col("_own").isNotNull(), F.col("_own")[c]).otherwise(F.col("_other")[c]))
    joined = joined.withColumns({c: text.unpacked_key(c) for c in hashes})
    place = F.coalesce("posicion", "_posicion") if "posicion" in stats.columns else F.col("_posicion")
    rated = joined.withColumn("posicion", place)
    for name, (parts, sign) in RATES.items():
        total = sum((F.col(p) for p in parts[1:]), F.col(parts[0]))
        rated = rated.withColumn(name, measures.per90(total, "minutos_jugados", sign))
    rated = (rated.withColumn("pie_zurdo", text.left_foot("pie"))
             .withColumn("altura", F.col("altura").try_cast("double"))
             .withColumn("posicion_xi", text.xi_code("posicion")))
    # Stored, as the median and then the rows are read from it.
    rated = stored(rated.drop("_own", "_other", "_teams", "_posicion"))
    return spread(aggregates.fill_median(rated, "altura"))


def component_weights(features: DataFrame, group: str, by_group: Mapping[str, Sequence[str]],
                      sign_of: Mapping[str, str]) -> DataFrame:
    """Per group: for each feature mean, deviation and weight of the first component, and the share it explains."""
    union = list(dict.fromkeys(f for fs in by_group.values() for f in fs))
    filled = features.filter(F.col(group).isin(list(by_group))).select(
        group, *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in union])
    gram = aggregates.gram_by(filled, group, union).filter(F.col("n") >= 2)

    def solve(rows):
        for pdf in rows:
            out = []
            for _, r in pdf.iterrows():
                names = list(by_group[r[group]])
                cov = np.array([[r[f"cov_{a}__{b}"] if f"cov_{a}__{b}" in r else r[f"cov_{b}__{a}"] for b in names] for a in names])
                dev = np.sqrt(np.clip(np.diag(cov), 0, None))
                spread = np.where(dev > 1e-12, dev, 1.0)
                corr = np.where((dev[:, None] > 1e-12) & (dev[None, :] > 1e-12), cov / np.outer(spread, spread), 0.0)
                values, vectors = np.linalg.eigh(corr)
                first = vectors[:, -1]
                ref = sign_of.get(r[group], names[0])
                if ref in names and (corr @ first)[names.index(ref)] < 0:
                    first = -first
                total = values.sum()
                out.append({group: r[group], "_feats": names, "_mean": [float(r[f"mean_{f}"]) for f in names],
                            "_dev": spread.tolist(), "_weight": np.where(dev > 1e-12, first, 0.0).tolist(),
                            "var_explicada": float(values[-1] / total) if total > 0 else 0.0})
            yield pd.DataFrame(out, columns=[group, "_feats", "_mean", "_dev", "_weight", "var_explicada"])

    return gram.mapInPandas(solve, f"{group} string, _feats array<string>, _mean array<double>, _dev array<double>, "
                                   "_weight array<double>, var_explicada double")


def _scored(weights: Mapping[str, tuple], by_group: Mapping[str, Sequence[str]], union: Sequence[str]) -> Callable:
    """Function of a group and the columns `union`: the row's z-scored features in the order of its group, `z`, and their weighted sum, `s`."""
    @F.arrow_udf("struct<z: array<double>, s: double>")
    def scored(group: pa.Array, *columns: pa.Array) -> pa.Array:
        x = {f: c.to_numpy(zero_copy_only=False) for f, c in zip(union, columns)}
        of = _codes(group, list(weights))
        width = np.array([len(by_group[g]) for g in weights] + [0])[of]
        ends = np.concatenate([[0], np.cumsum(width)])
        flat, total = np.empty(ends[-1]), np.zeros(len(of))
        for code, (g, (means, devs, ws)) in enumerate(weights.items()):
            mine = np.flatnonzero(of == code)
            for i, f in enumerate(by_group[g]):
                z = (x[f][mine] - means[i]) / devs[i]
                flat[ends[mine] + i] = z
                total[mine] += z * ws[i]
        none = pa.array(of == len(weights))
        z = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat), mask=none)
        return pa.StructArray.from_arrays([z, pa.array(total, mask=of == len(weights))], ["z", "s"])

    return scored


def _codes(group: pa.Array, names: Sequence) -> np.ndarray:
    """Places of the values in `names`; their number for any other."""
    found = pc.index_in(group, value_set=pa.array(list(names), group.type))
    return pc.fill_null(found, len(names)).to_numpy(zero_copy_only=False)


def component_scores(features: DataFrame, group: str = "posicion_xi",
                     by_group: Mapping[str, Sequence[str]] = fixed.SCORE_FEATURES,
                     sign_of: Mapping[str, str] = fixed.SCORE_SIGN_REFERENCE, score: str = "score_ml") -> DataFrame:
    """Adds the score, the explained share and the z-scored features `_z`; the score is NULL in groups below two rows
    and in groups without a configuration."""
    weights = stored(component_weights(features, group, by_group, sign_of))
    # At most one row per configured group, so the broadcast and the weights read here are bounded by the configuration.
    known = {r[group]: (r["_mean"], r["_dev"], r["_weight"]) for r in weights.orderBy(group).collect()}
    joined = features.join(F.broadcast(weights.select(group, "var_explicada")), group, "left")
    union = list(dict.fromkeys(f for fs in by_group.values() for f in fs))
    filled = [F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in union]
    both = joined.withColumn("_s", _scored(known, by_group, union)(F.col(group), *filled))
    return both.withColumn("_z", F.col("_s.z")).withColumn(score, F.col("_s.s")).drop("_s")


UNIT = 1_000_000  # standardised features are whole millionths, so that sums over rows are exact
MOST_OPEN = 20_000


# Rows whose sums a task adds up before it hands them on: halves of the numbers of so many rows overflow nowhere.
ROWS_HELD = 1 << 18


def _whole(v: np.ndarray) -> np.ndarray:
    """Millionths, halves rounded away from zero."""
    v = v * UNIT
    if not (np.abs(v) < 2.0**63).all():
        raise ValueError("a standardised feature is no finite number, or too large")
    low = np.trunc(v)
    return (low + np.copysign(np.abs(v - low) >= 0.5, v)).astype("int64")


@F.arrow_udf(T.ArrayType(T.LongType()))
def _whole_vectors(z: pa.Array) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(z), 0).to_numpy(zero_copy_only=False))])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(_whole(z.flatten().to_numpy(zero_copy_only=False))), mask=z.is_null())


def _blocks(codes: np.ndarray, vectors: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The vectors of each code below the number of codes as a matrix, with the places of its rows."""
    length = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
    values, begin = vectors.flatten().to_numpy(zero_copy_only=False), np.cumsum(length) - length
    for code in np.unique(codes):
        at = np.flatnonzero(codes == code)
        yield int(code), at, values[begin[at][:, None] + np.arange(length[at[0]])]


def _nearest(q: np.ndarray, centre: Sequence[Sequence[int]]) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each row, the first of equally near ones, and in which ring the row lies: by at least how much farther the
    next centre is, less what the rounding of doubles can make."""
    far = np.zeros((len(centre), len(q)))
    for j, c in enumerate(centre):
        for i, x in enumerate(c):
            apart = (q[:, i] - x).astype("float64")
            far[j] += apart * apart
    part = far.argmin(axis=0)
    if len(centre) < 2:
        return part, np.full(len(q), RINGS - 1)
    one, two = np.sqrt(np.partition(far, 1, axis=0)[:2])
    margin = two - one - (two + one) * 1e-12 - 1
    return part, np.minimum(np.floor(np.log2(np.clip(margin, 1.0, 1e18)) * 4).astype("int64"), RINGS - 1)


def _counted(rows: DataFrame, group: str, width: int, k: int, centres: Mapping[int, list[list[int]]] | None = None) -> list:
    """Per group, cluster and ring: (group, cluster, ring, rows, sums of the features), added up in the partitions first. Without
    `centres` the cluster is the column `_part`."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seen = {}, 0

        def out() -> pa.RecordBatch:
            keys = [(code, key) for code, (n, _, _) in held.items() for key in np.flatnonzero(n)]
            sums = [pa.array([held[code][h][key].tolist() for code, key in keys], pa.list_(pa.int64())) for h in (1, 2)]
            columns = [pa.array(v, pa.int32()) for v in ([c for c, _ in keys], [int(x) // RINGS for _, x in keys], [int(x) % RINGS for _, x in keys])]
            batch = pa.record_batch([*columns, pa.array([int(held[c][0][x]) for c, x in keys], pa.int64()), *sums], [group, "_part", "_ring", "n", "hi", "lo"])
            held.clear()
            return batch

        for batch in batches:
            for code, at, q in _blocks(batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)):
                if centres is None:
                    key = batch.column(2).to_numpy(zero_copy_only=False)[at].astype("int64") * RINGS
                elif code in centres:
                    part, ring = _nearest(q, centres[code])
                    key = part * RINGS + ring
                else:
                    continue
                if code not in held:
                    held[code] = np.zeros(k * RINGS, "int64"), np.zeros((k * RINGS, width), "int64"), np.zeros((k * RINGS, width), "int64")
                order = np.argsort(key, kind="stable")
                keys, starts = np.unique(key[order], return_index=True)
                n, hi, lo = held[code]
                n[keys] += np.diff(np.append(starts, len(key)))
                hi[keys, : q.shape[1]] += np.add.reduceat((q >> 20)[order], starts, axis=0)
                lo[keys, : q.shape[1]] += np.add.reduceat((q & 0xFFFFF)[order], starts, axis=0)
            seen += batch.num_rows
            if seen >= ROWS_HELD:
                yield out()
                seen = 0
        if held:
            yield out()

    few = rows.select(group, "_q", *(["_part"] if centres is None else []))
    found = few.mapInArrow(count, f"{group} int, _part int, _ring int, n bigint, hi array<bigint>, lo array<bigint>")
    sums = [F.sum(F.get(h, F.lit(i)).cast("decimal(20,0)")).alias(f"{h}{i}") for i in range(width) for h in ("hi", "lo")]
    return [(r[group], r["_part"], r["_ring"], r["n"], [(int(r[f"hi{i}"]) << 20) + int(r[f"lo{i}"]) for i in range(width)])
            for r in found.groupBy(group, "_part", "_ring").agg(F.sum("n").alias("n"), *sums).collect()]


def _centres(rows: DataFrame, group: str, k: int, sizes: Mapping[int, int], widths: Mapping[int, int], most_rounds: int, most_open: int) -> dict[int, list[list[int]]]:
    """Centres of each group's clusters: Lloyd rounds for all groups together until no centre moves, as many as can be told in each pass.

    The first centres are the means of k equal parts of the group in the order of (score, hash of the features). Means of whole numbers are
    rounded halves up, so nothing depends on the order or the place of the rows."""
    width = max(widths.values(), default=0)
    place = F.struct(F.col("_score").alias("s"), F.xxhash64("_q").alias("h"))
    ranked = ranking.rank_table(rows.select(group, "_score", F.xxhash64("_q").alias("_h")), [group], [("_score", "asc"), ("_h", "asc")], "_rank")
    begins = rows.sparkSession.createDataFrame([(g, j, -(-j * n // k) + 1) for g, n in sizes.items() for j in range(1, k)], "_g int, _j int, _r int")
    cuts = ranked.join(F.broadcast(begins), (F.col(group) == F.col("_g")) & (F.col("_rank") == F.col("_r"))).groupBy("_g").agg(F.collect_list(F.struct(F.col("_score").alias("s"), F.col("_h").alias("h"))).alias("_cuts"))
    cut = rows.join(F.broadcast(stored(cuts)), F.col(group) == F.col("_g"))
    passed = [F.coalesce((F.get("_cuts", F.lit(j)) <= place).cast("int"), F.lit(0)) for j in range(k - 1)]
    parts = _counted(cut.withColumn("_part", sum(passed, F.lit(0))), group, width, k)
    first = {(g, j): _mean(n, total[:widths[g]]) for g, j, _, n, total in parts}
    centres = {g: [first[g, j] for j in range(k) if (g, j) in first] for g in sizes}
    left = dict.fromkeys(sizes, most_rounds)
    while still := {g: centres[g] for g in sizes if left[g] > 0}:
        # One pass over all rows: sums by cluster, and how many rows lie how near to the border between two clusters.
        counted: dict[int, list] = {g: [] for g in still}
        for g, part, ring, n, total in _counted(rows, group, width, k, still):
            counted[g].append((ring, part, n, total[:widths[g]]))
        going = {}
        for g, old in still.items():
            n, s, near = [0] * len(old), [[0] * len(c) for c in old], 0
            for _, j, m, t in counted[g]:
                n[j], s[j] = n[j] + m, [a + b for a, b in zip(s[j], t)]
            centres[g] = [_mean(m, t) if m else c for m, t, c in zip(n, s, old)]
            left[g] = left[g] - 1 if centres[g] != old else 0
            rings: dict[int, int] = {}
            for ring, _, m, _ in counted[g]:
                rings[ring] = rings.get(ring, 0) + m
            ring = RINGS
            for at in sorted(rings):
                near += rings[at]
                if near > most_open:
                    ring = at
                    break
            # Rows of this ring and beyond keep their cluster until a centre has moved by half of the ring's inner distance.
            clear = float("inf") if ring == RINGS else 2 ** (ring / 4) * (1 - 1e-9)
            if left[g] and 2 * _moved(old, centres[g]) < clear:
                going[g] = (ring, clear, old, centres[g], n, s, left[g])
        if going:
            for r in _go_on(rows, group, going).collect():
                centres[r[group]], left[r[group]] = [list(c) for c in r["_c"]], r["_left"]
    return centres


def _mean(n: int, s: Sequence[int]) -> list[int]:
    return [(2 * t + n) // (2 * n) for t in s]


def _moved(before: Sequence[Sequence[int]], after: Sequence[Sequence[int]]) -> float:
    """The longest way of a centre."""
    return max(sum(float(a - b) ** 2 for a, b in zip(c, d)) ** 0.5 for c, d in zip(before, after))


# Rings of a quarter of a power of two of `_margin`.
RINGS = 240


def _go_on(rows: DataFrame, group: str, going: Mapping[int, tuple]) -> DataFrame:
    """Further rounds of groups of which few rows are near a border: one task a group takes these rows only, adds the sums of all
    others, and stops when a centre has moved so far that others could change."""
    inside = {g: (state[0], state[2]) for g, state in going.items()}

    def bordering(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for code, at, q in _blocks(batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)):
                if code in inside:
                    part, ring = _nearest(q, inside[code][1])
                    close = np.flatnonzero(ring < inside[code][0])
                    if len(close):
                        yield pa.record_batch([pa.array(np.full(len(close), code, "int32")), batch.column(1).take(pa.array(at[close])), pa.array(part[close].astype("int32"))], [group, "_q", "_part"])

    near = rows.select(group, "_q").mapInArrow(bordering, f"{group} int, _q array<bigint>, _part int")

    def rounds(key, pdf):
        _, clear, base, centre, n, s, left = going[int(key[0])]
        k, width = len(base), len(base[0])
        q = np.array(pdf["_q"].tolist(), dtype="int64").reshape(len(pdf), width)

        def sums(part):
            """Rows and sums by cluster; halves of the numbers are added up apart, so that none overflows."""
            m, t = [], []
            for j in range(k):
                mine = q[part == j]
                m.append(len(mine))
                t.append([(int(h) << 20) + int(l) for h, l in zip((mine >> 20).sum(axis=0), (mine & 0xFFFFF).sum(axis=0))])
            return m, t

        m, t = sums(pdf["_part"].to_numpy())
        rest_n = [a - b for a, b in zip(n, m)]
        rest_s = [[x - y for x, y in zip(a, b)] for a, b in zip(s, t)]
        while left > 0 and 2 * max(sum(float(a - b) ** 2 for a, b in zip(c, d)) ** 0.5 for c, d in zip(base, centre)) < clear:
            m, t = sums(_nearest(q, centre)[0])
            after = []
            for j in range(k):
                of = rest_n[j] + m[j]
                after.append([(2 * (a + b) + of) // (2 * of) for a, b in zip(rest_s[j], t[j])] if of else centre[j])
            left = left - 1 if after != centre else 0
            centre = after
        return pd.DataFrame({group: [int(key[0])], "_c": [centre], "_left": [left]})

    return near.groupBy(group).applyInPandas(rounds, f"{group} int, _c array<array<bigint>>, _left int")


def cluster_levels(scored: DataFrame, group: str = "posicion_xi",
                   by_group: Mapping[str, Sequence[str]] = fixed.SCORE_FEATURES, k: int = 4,
                   score: str = "score_ml", most_rounds: int = 300, most_open: int = MOST_OPEN) -> DataFrame:
    """Clusters each group on its z-scored features and numbers the clusters by mean score, lowest first.

    Groups with fewer than 2k rows get no level; one with many equal rows can have fewer than k levels. The levels do not depend
    on the order or the partitions of the rows, nor on `most_open`, the rows of a group near a border that one task may take to go on with
    the rounds. `scored` is read twice: for the features, which are stored, and for the result."""
    names = list(by_group)
    widths = {code: len(by_group[g]) for code, g in enumerate(names)}
    code = (F.array_position(F.array(*map(F.lit, names)), F.col(group)) - 1).cast("int").alias("_code")
    known = F.coalesce(F.col(group).isin(names), F.lit(False))
    rows = scored.filter(known).select(code, _whole_vectors("_z").alias("_q"), F.round(F.col(score) * UNIT).cast("bigint").alias("_score"))
    rows = stored(rows.filter("_q IS NOT NULL"))
    sizes = {r["_code"]: r["n"] for r in rows.groupBy("_code").agg(F.count(F.lit(1)).alias("n")).orderBy("_code").collect() if r["n"] >= 2 * k}
    inside = rows.filter(F.col("_code").isin(list(sizes)))
    rows = spread(inside)
    rows = inside if rows is inside else stored(rows)  # a small table moves once, not in each pass
    centres = _centres(rows, "_code", k, sizes, {c: widths[c] for c in sizes}, most_rounds, most_open)

    @F.arrow_udf("int")
    def cluster(codes: pa.Array, q: pa.Array) -> pa.Array:
        of = codes.to_numpy(zero_copy_only=False)
        part = np.zeros(len(of), "int32")
        for c, at, block in _blocks(of, q):
            part[at] = _nearest(block, centres[c])[0]
        return pa.array(part)

    mean = F.sum(F.col("_score").cast("decimal(18,0)")) / F.count(F.lit(1))
    order = sorted((r["_code"], r["m"], r["_part"]) for r in rows.withColumn("_part", cluster("_code", "_q")).groupBy("_code", "_part").agg(mean.alias("m")).collect())
    number: dict[int, list[int]] = {c: [-1] * len(cs) for c, cs in centres.items()}
    for c in centres:
        for i, j in enumerate(j for d, _, j in order if d == c):
            number[c][j] = i

    @F.arrow_udf("int")
    def level(groups: pa.Array, z: pa.Array) -> pa.Array:
        of = np.where(z.is_null().to_numpy(zero_copy_only=False), len(names), _codes(groups, names))
        found = np.full(len(of), -1, "int32")
        for c, at, block in _blocks(of, z):
            if c in centres:
                found[at] = np.array(number[c], "int32")[_nearest(_whole(block), centres[c])[0]]
        return pa.array(found, mask=found < 0)

    leveled = scored.withColumn("nivel_num", level(F.col(group), "_z"))
    return leveled.withColumn("nivel", text.map_label("nivel_num", dict(enumerate(fixed.LEVELS))))


def score_players(stats: DataFrame, squads: DataFrame, as_of: Column | None = None,
                  by_group: Mapping[str, Sequence[str]] = fixed.SCORE_FEATURES,
                  sign_of: Mapping[str, str] = fixed.SCORE_SIGN_REFERENCE, k: int = 4,
                  min_minutes: int = fixed.MIN_MINUTES) -> DataFrame:
    # No score column needs the hashed key of the statistics, which is as large as a third of the row.
    stats = stats.drop("id_estadistica_jugador")
    scored = component_scores(player_features(stats, squads, min_minutes), by_group=by_group, sign_of=sign_of)
    leveled = cluster_levels(scored, by_group=by_group, k=k)
    return score_rows(ranking.minmax_by(leveled, "posicion_xi", "score_ml"), as_of)


def score_rows(leveled: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Key and columns of the published score table."""
    key = F.md5(F.concat_ws("_", "id_jugador", F.col("id_equipo").cast("string"), F.col("temporada").cast("string")))
    columns = ["id_jugador", "id_tm", "jugador", "foto_url", "id_equipo", "nombre_equipo", "alias_equipo", "temporada",
               "posicion", "posicion_xi", "partidos_jugados", "titularidades", "minutos_jugados", "goles", "asistencias",
               "ppp", "tarjetas_amarillas", "tarjeta_amarilla_roja", "tarjetas_rojas", "entrada_suplente", "salida_suplente",
               "min_por_gol", "goles_en_contra", "partidos_imbatido", *RATES, "score_ml", "score_100", "var_explicada",
               "nivel_num", "nivel"]
    return leveled.select(key.alias("id_score_ml"), *columns,
                          (F.current_timestamp() if as_of is None else as_of).alias("fecha_carga"),
                          F.col("temporada").alias("periodo"))


def score_summary(score: DataFrame, few_minutes: int = 900, many_minutes: int = 1800,
                  low_score: float = 40.0) -> DataFrame:
    """The four lists of the score's overview, told apart by `tipo`: players per level and mean score per season, and by name
    the hidden gems (a high level in few minutes) and the regular players with a low score."""
    levels = score.groupBy(F.coalesce("nivel", F.lit("Sin nivel")).alias("grupo")).agg(
        F.count(F.lit(1)).alias("jugadores"), F.round(F.avg("score_100"), 2).alias("score_medio"))
    years = score.groupBy(F.col("temporada").cast("string").alias("grupo")).agg(
        F.count(F.lit(1)).alias("jugadores"), F.round(F.avg("score_100"), 2).alias("score_medio"))
    person = score.withColumn("_one", F.concat_ws("|", "jugador", "nombre_equipo", F.col("temporada").cast("string"), "posicion_xi"))
    gems = person.filter(F.col("nivel").isin(fixed.LEVELS[-2:]) & (F.col("minutos_jugados") <= few_minutes))
    idle = person.filter((F.col("minutos_jugados") >= many_minutes) & (F.col("score_100") <= low_score))
    lists = [levels.withColumn("tipo", F.lit("nivel")), years.withColumn("tipo", F.lit("temporada"))]
    for rows, name in ((gems, "gema"), (idle, "titular_bajo")):
        lists.append(rows.groupBy(F.col("_one").alias("grupo")).agg(F.count(F.lit(1)).alias("jugadores"), F.round(F.avg("score_100"), 2).alias("score_medio"))
                     .withColumn("tipo", F.lit(name)))
    out = lists[0]
    for rows in lists[1:]:
        out = out.unionByName(rows)
    return out
