"""Parts of the queries' SQL counterparts that are made from rules."""

from __future__ import annotations

LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: Levels of runs that the SQL has room for: 16 to these powers leaves a source, and sources.
LEAF_LEVELS, TOP_LEVELS = 6, 3


def crc32(codes: str) -> str:
    """The unsigned CRC-32 of a list of byte values."""
    step = "lambda x, i: xor(x >> 1, 3988292384 * (x & 1))"
    byte = f"lambda c, b: list_reduce([xor(c, b)] || [0, 0, 0, 0, 0, 0, 0, 0], {step})"
    return f"xor(list_reduce([4294967295::BIGINT] || {codes}, {byte}), 4294967295)"


def codes(text: str) -> str:
    """The UTF-8 bytes of a text of ASCII characters and U+00C0 to U+00FF."""
    return (
        f"flatten(list_transform(string_split({text}, ''), "
        "lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, unicode(c) - 64] END))"
    )


def merkle() -> str:
    """The manifest of op12, its levels written out."""

    def leaf(text: str) -> str:
        parts = [f"coalesce(strlen({c}) || ':' || {c}, '-')" for c in ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)]
        return f"sha256({' || '.join(parts)})"

    def levels(name: str, height: int) -> list[str]:
        out = []
        for k in range(1, height + 1):
            out.append(
                f"""{name}{k} AS (
        SELECT g, pos // 16 AS pos, c, list(h ORDER BY pos) AS m,
            CASE WHEN c = 1 THEN max(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h
        FROM (SELECT g, pos, h, count(*) OVER (PARTITION BY g) AS c FROM {name}{k - 1}) GROUP BY g, pos // 16, c)"""
            )
        return out

    def way(name: str, height: int, place: str, group: str) -> tuple[list[str], list[str]]:
        """Joins to the runs on a node's way, and (left, right) of each."""
        joins, steps = [], []
        for k in range(1, height + 1):
            t = f"{name}{k}"
            slot = f"(({place} // {16 ** (k - 1)}) % 16)"
            joins.append(f"JOIN {t} ON {t}.g = {group} AND {t}.pos = {place} // {16**k}")
            one = f"{t}.c = 1"
            steps.append(
                (
                    one,
                    f"CASE WHEN {one} THEN '' ELSE array_to_string({t}.m[1 : {slot}], '') END",
                    f"CASE WHEN {one} THEN '' ELSE array_to_string({t}.m[{slot} + 2 : 16], '') END",
                )
            )
        return joins, steps

    low = LOWER.format("text")
    changed = f"{crc32(codes('doc_id::VARCHAR'))} % 5 = 0"
    joins, steps = way("s", LEAF_LEVELS, "l.pos", "l.g")
    more, above = way("t", TOP_LEVELS, "o.pos", "''")
    steps += above
    ctes = [
        f"""l AS (
        SELECT doc_id, CASE WHEN source IS NULL THEN '0' ELSE '1' || source END AS g, {leaf('text')} AS leaf,
            CASE WHEN {changed} THEN {leaf(low)} ELSE {leaf('text')} END AS copy,
            row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, {leaf('text')}) - 1 AS pos
        FROM documents)""",
        "s0 AS (SELECT g, pos, leaf AS h FROM l)",
        *levels("s", LEAF_LEVELS),
        f"o AS (SELECT g AS name, h, row_number() OVER (ORDER BY g) - 1 AS pos FROM s{LEAF_LEVELS})",
        "t0 AS (SELECT '' AS g, pos, h FROM o)",
        *levels("t", TOP_LEVELS),
    ]
    proof = " || ".join(f"{a} || {b}" for _, a, b in steps)
    folds, before = [], "copy"
    sides = []
    for k, (one, left, right) in enumerate(steps):
        sides += [f"{one} AS one{k}", f"{left} AS left{k}", f"{right} AS right{k}"]
    ctes.append(
        f"""w AS (SELECT doc_id, leaf, copy, o.h AS subroot, t{TOP_LEVELS}.h AS root, sha256({proof}) AS proof_sha256,
        {', '.join(sides)}
        FROM l {' '.join(joins)} JOIN o ON o.name = l.g {' '.join(more)})"""
    )
    for k in range(len(steps)):
        folds.append(
            f"f{k} AS (SELECT * EXCLUDE (copy), CASE WHEN one{k} THEN copy ELSE sha256(left{k} || copy || right{k}) END AS copy FROM {'w' if not k else f'f{k - 1}'})"
        )
    ctes += folds
    return (
        f"WITH {', '.join(ctes)} SELECT doc_id, leaf, subroot, root, proof_sha256, copy AS folded_root, copy = root AS verified "
        f"FROM f{len(steps) - 1}"
    )


def spelling() -> str:
    """Near words of op11 by texts with one letter left out: equal after leaving one out of either, or of both
    at the same place."""
    run = LOWER.format("r")
    key = f"list_concat({codes('''doc_id::VARCHAR || ':' ''')}, {codes('r')})"
    return f"""
    WITH RECURSIVE run AS (
        SELECT doc_id, r, count(*) AS n FROM (
            SELECT coalesce(doc_id::VARCHAR, '') AS doc_id, {run} AS r
            FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS r FROM documents))
        WHERE length(r) >= 6 GROUP BY ALL),
    crc AS (SELECT r, n, {crc32(key)} AS h FROM run),
    made AS (
        SELECT CASE WHEN h % 199 = 0 THEN r[1 : h % length(r)] || r[h % length(r) + 2 :] ELSE r END AS word, n FROM crc),
    v AS (SELECT word, sum(n)::BIGINT AS n FROM made WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
    d AS (
        SELECT word, n, i, word[1 : i] || word[i + 2 :] AS rest
        FROM (SELECT word, n, unnest(range(length(word))) AS i FROM v)),
    near AS (
        SELECT a.word, b.word AS near, b.n FROM d a JOIN v b ON a.rest = b.word
        UNION SELECT b.word, a.word, a.n FROM d a JOIN v b ON a.rest = b.word
        UNION SELECT a.word, b.word, b.n FROM d a JOIN d b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word),
    best AS (
        SELECT word, count(*) AS n_near, max(n) AS most, arg_min(near, (-n, near)) AS form FROM near GROUP BY word),
    f AS (
        SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 5 * v.n THEN form END AS form,
            CASE WHEN most >= 5 * v.n THEN most END AS form_n
        FROM v LEFT JOIN best USING (word)),
    up AS (
        SELECT word, form, word AS root FROM f
        UNION ALL SELECT up.word, f.form, f.word FROM up JOIN f ON up.form = f.word)
    SELECT f.word, f.form, root, f.n, f.n_near, f.form_n FROM f JOIN (SELECT word, root FROM up WHERE form IS NULL) USING (word)
    """


WARC = """
    WITH p AS (SELECT page_id, coalesce(encode(html), ''::BLOB) AS b FROM pages),
    k AS (SELECT page_id, octet_length(b) AS size, sha1(b) AS digest, sha256(b) AS same FROM p),
    m AS (SELECT same, max(page_id) AS last FROM k WHERE size >= 1000 GROUP BY same)
    SELECT page_id, size AS payload_bytes, digest AS payload_digest,
        CASE WHEN page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN page_id < last THEN last END AS refers_to
    FROM k LEFT JOIN m USING (same)
"""
