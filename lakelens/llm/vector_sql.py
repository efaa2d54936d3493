"""SQL that the two vector queries have to agree with: a full search in every round, one common table per round."""

from __future__ import annotations

KEPT = """
    kept AS MATERIALIZED (
      SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0{more})"""
SQUARED = "list_sum(list_transform(list_zip({0}, {1}), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
FLOOR = "CAST((sum({0}) - (((sum({0}) % count(*)) + count(*)) % count(*))) // count(*) AS BIGINT)"


def cluster_sql(k: int = 8, rounds: int = 10) -> str:
    """Rows of `centroid_clusters` over embeddings."""
    steps = [
        "WITH" + KEPT.format(more=" AND len(embedding) = 64"),
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c, v FROM kept QUALIFY c < {k})",
    ]
    distance = SQUARED.format("kept.v", "c.v")
    for i in range(rounds + 1):
        steps.append(
            f"a{i} AS MATERIALIZED (SELECT vec_id, kept.v, c.c, CAST({distance} AS BIGINT) AS d FROM kept CROSS JOIN c{i} c "
            "QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c.c) = 1)"
        )
        if i < rounds:
            steps.append(f"m{i} AS (SELECT c, i, {FLOOR.format('v[i]')} AS x FROM a{i}, range(1, 65) AS r(i) GROUP BY c, i)")
            steps.append(
                f"c{i + 1} AS MATERIALIZED (SELECT c{i}.c, coalesce(n.v, c{i}.v) AS v FROM c{i} "
                f"LEFT JOIN (SELECT c, list(x ORDER BY i) AS v FROM m{i} GROUP BY c) n ON n.c = c{i}.c)"
            )
    last = f"a{rounds}"
    return ",\n".join(steps) + (
        f"\nSELECT vec_id, CAST({last}.c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY {last}.c) AS BIGINT) AS cluster_inertia, "
        f"CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256 "
        f"FROM {last} JOIN c{rounds} ON c{rounds}.c = {last}.c"
    )


def code_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Rows of `vector_codes` over embeddings."""
    steps = [
        "WITH" + KEPT.format(more=""),
        f"cut AS MATERIALIZED (SELECT vec_id, p, list_slice(v, p * len(v) // {parts} + 1, (p + 1) * len(v) // {parts}) AS v FROM kept, range({parts}) AS r(p))",
        f"e0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, v FROM cut QUALIFY e < {entries})",
    ]
    distance = SQUARED.format("cut.v", "e.v")
    for i in range(rounds + 1):
        steps.append(
            f"a{i} AS MATERIALIZED (SELECT vec_id, p, any_value(v) AS v, min(struct_pack(d := d, e := e)) AS best FROM "
            f"(SELECT vec_id, cut.p, cut.v, e.e, CAST({distance} AS BIGINT) AS d FROM cut JOIN e{i} e ON e.p = cut.p) GROUP BY vec_id, p)"
        )
        if i < rounds:
            steps.append(f"m{i} AS (SELECT p, best.e AS e, i, {FLOOR.format('v[i]')} AS x FROM a{i}, range(1, len(v) + 1) AS r(i) GROUP BY p, best.e, i)")
            steps.append(
                f"e{i + 1} AS MATERIALIZED (SELECT e{i}.p, e{i}.e, coalesce(n.v, e{i}.v) AS v FROM e{i} "
                f"LEFT JOIN (SELECT p, e, list(x ORDER BY i) AS v FROM m{i} GROUP BY p, e) n ON n.p = e{i}.p AND n.e = e{i}.e)"
            )
    steps.append(
        f"done AS (SELECT vec_id, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id)"
    )
    steps.append(f"books AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM e{rounds})")
    return ",\n".join(steps) + (
        "\nSELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 "
        "FROM done JOIN kept USING (vec_id), books"
    )
