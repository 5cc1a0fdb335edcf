"""SQL for the queries that SQL can express."""

ORACLES: dict[str, str] = {
    "op5_ngram_jaccard": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS ws
            FROM documents
        ), g AS (
            SELECT DISTINCT doc_id, unnest(
                CASE WHEN len(ws) = 0 THEN []
                     WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
                     ELSE [array_to_string(ws[i:i + 2], ' ') FOR i IN range(1, len(ws) - 1)]
                END) AS shingle
            FROM w
        ), n AS (
            SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id
        ), p AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
            FROM g a JOIN g b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
        ), l AS (
            SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b
            WHERE 100 * c >= 90 * (x.n + y.n - c)
        ), both_ways AS (
            SELECT a, b FROM l UNION ALL SELECT b, a FROM l
        ), reach(doc_id, other) AS (
            SELECT doc_id, doc_id FROM documents
            UNION
            SELECT r.doc_id, e.b FROM reach r JOIN both_ways e ON e.a = r.other
        )
        SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.other) AS component_id
        FROM reach r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
    """,
    "op10_warc": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                   sha256(coalesce(html, '')) AS payload_digest
            FROM pages
        ), f AS (
            SELECT *, CASE WHEN payload_bytes >= 100
                      THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first
            FROM p
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first
                    THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
        FROM f
    """,
}
