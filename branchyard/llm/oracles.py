"""SQL that is put together level by level: Merkle trees of eight, and repeated passages."""

from __future__ import annotations

#: Levels that the SQL unrolls: trees of up to 8 ** 6 leaves, and 8 ** 3 trees.
INNER, OUTER = 6, 3


def _trees(name: str, leaves: str, levels: int) -> list[str]:
    """CTEs name_0 .. of nodes and name_r0 .. of runs; a tree of one node stays as it is."""
    out = [f"{name}_0 AS ({leaves})"]
    for k in range(levels):
        out.append(f"{name}_r{k} AS (SELECT tree, place // 8 AS up, any_value(size) AS size, list(h ORDER BY place) AS hs FROM {name}_{k} GROUP BY ALL)")
        out.append(
            f"{name}_{k + 1} AS (SELECT tree, up AS place, (size + 7) // 8 AS size,"
            f" CASE WHEN size = 1 THEN hs[1] ELSE sha256(array_to_string(hs, '')) END AS h FROM {name}_r{k})"
        )
    return out


def _way(name: str, levels: int, tree: str, place: str, before: str) -> tuple[list[str], str]:
    """CTEs that carry each row's proof and folded digest up through the levels of a tree."""
    out = []
    for k in range(levels):
        at = f"({place} // {8**k}) % 8"
        left, right = f"array_to_string(hs[1:{at}], '')", f"array_to_string(hs[{at} + 2:], '')"
        out.append(
            f"{name}_p{k} AS (SELECT d.* REPLACE (proof || {left} || {right} AS proof,"
            f" CASE WHEN r.size = 1 THEN folded ELSE sha256({left} || folded || {right}) END AS folded)"
            f" FROM {before} d JOIN {name}_r{k} r ON r.tree = {tree} AND r.up = {place} // {8 ** (k + 1)})"
        )
        before = f"{name}_p{k}"
    return out, before


def merkle() -> str:
    field = lambda v: f"CASE WHEN {v} IS NULL THEN '-' ELSE strlen({v}::VARCHAR)::VARCHAR || ':' || {v}::VARCHAR END"
    leaf = lambda text: "sha256(" + " || ".join(field(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    small = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    # the public CRC-32: reflected polynomial 0xEDB88320, all ones before and after
    crc = (
        "xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),"
        " lambda a, c: list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)), xor(a, c)), 4294967295::BIGINT), 4294967295)"
    )
    ctes = [
        f"d AS (SELECT doc_id, coalesce('s' || lang, 'n') AS tree, {leaf('text')} AS leaf, CASE WHEN {crc} % 3 = 0 THEN {leaf(small)} ELSE {leaf('text')} END AS shown FROM documents)",
        "placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY tree) AS size FROM d)",
        *_trees("i", "SELECT tree, place, size, leaf AS h FROM placed", INNER),
        *_trees("o", f"SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS size, h, tree AS of FROM i_{INNER}", OUTER),
    ]
    way, last = _way("i", INNER, "d.tree", "d.place", "start")
    over, end = _way("o", OUTER, "''", "d.top", last)
    ctes.append("start AS (SELECT p.*, t.h AS subroot, t.place AS top, '' AS proof, shown AS folded FROM placed p JOIN o_0 t ON t.of = p.tree)")
    return (
        f"WITH {', '.join([*ctes, *way, *over])} SELECT doc_id, leaf, subroot, r.h AS root, sha256(proof) AS proof_sha256,"
        f" folded AS folded_root, folded = r.h AS verified FROM {end}, o_{OUTER} r"
    )


REPEATED_SPANS = r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    w AS (SELECT doc_id, len(ws) AS n, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM d),
    k AS (
        SELECT *, i + 49 <= n AND doc_id IS NOT NULL AS whole,
            md5(string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)) AS h
        FROM w
    ),
    f AS (SELECT h, min(doc_id) AS first FROM k WHERE whole GROUP BY h),
    s AS (SELECT k.*, coalesce(whole AND first < doc_id, false) AS starts FROM k LEFT JOIN f USING (h)),
    c AS (SELECT doc_id, word, i, bool_or(starts) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM s),
    g AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM c GROUP BY doc_id)
    SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM d LEFT JOIN g ON g.doc_id = d.doc_id
"""
