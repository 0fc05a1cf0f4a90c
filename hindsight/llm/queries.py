"""The registered queries of this subpackage, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import functions as F

from querybook.base import Book

from hindsight.llm import fingerprints, merkle, mixing, order_minhash, packing, pii, preference, ranking, secrets, spans, toxicity, urls, vectors, wrappers
from hindsight.llm.work import table

book = Book()


@book.add()
def op1_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


RULES = [
    urls.Rule("com/", "allow"),
    urls.Rule("example.com/en/", "block"),
    urls.Rule("www.example.com/en/", "allow"),
    urls.Rule("net/es/", "block"),
    urls.Rule("net/fr/", "block"),
]


@book.add()
def op2_url_filter(spark, sf_dir):
    return urls.judge(table(spark, sf_dir, "pages"), RULES)


@book.add()
def op3_mixing(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"), [3, 1, 2], 1.5)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@book.add()
def op4_fingerprints(spark, sf_dir):
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def _count(kind):
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def _digests(found, base):
    """Counts of base kinds, hash of their spans, all spans, in the order that ``found`` has them in."""
    of_base = F.filter("spans", lambda s: s["kind"].isin(base))
    return found.select(
        "doc_id", *[_count(k) for k in base], F.sha2(spans.digest(of_base), 256).alias("base_sha256"), spans.digest(F.col("spans")).alias("spans")
    )


@book.add()
def op5_personal_data(spark, sf_dir):
    return _digests(pii.find(table(spark, sf_dir, "documents")), [k.name for k in pii.KINDS if k.always])


@book.add()
def op6_secrets(spark, sf_dir):
    return _digests(secrets.find(table(spark, sf_dir, "documents")), [r.name for r in secrets.RULES if r.base])


@book.add(
    """
    WITH t AS (
        SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
        FROM conversations WHERE conv_id IS NOT NULL
    ), n AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
            count(*) OVER (PARTITION BY conv_id) AS size
        FROM t
    ), side AS (
        SELECT conv_id, k, role, text, 'chosen' AS side FROM n
        UNION ALL
        SELECT conv_id, k, role, text, 'rejected' FROM n WHERE k <= (conv_id % size + size) % size
        UNION ALL
        SELECT a.conv_id, b.k, b.role, b.text, 'rejected' FROM (SELECT DISTINCT conv_id, size FROM n) a JOIN n b ON b.conv_id = xor(a.conv_id, 1)
        WHERE b.k > (a.conv_id % a.size + a.size) % a.size
    ), equal AS (
        SELECT conv_id, k, count(*) = 2 AND count(DISTINCT (role, text)) = 1 AS same FROM side GROUP BY conv_id, k
    ), cut AS (
        SELECT conv_id, coalesce(min(k) FILTER (NOT same), max(k) + 1) - 1 AS p FROM equal GROUP BY conv_id
    ), drawn AS (
        SELECT side.*, p, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS line,
            length(role) + 5 AS head FROM side JOIN cut USING (conv_id)
    ), placed AS (
        SELECT *, coalesce(sum(length(line)) OVER (PARTITION BY conv_id, side, k > p ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begun
        FROM drawn
    )
    SELECT conv_id AS pair_id, any_value(p)::INT AS prompt_turns,
        coalesce(string_agg(line, '' ORDER BY k) FILTER (k <= p AND side = 'chosen'), '') AS prompt,
        coalesce(string_agg(line, '' ORDER BY k) FILTER (k > p AND side = 'chosen'), '') AS chosen,
        coalesce(string_agg(line, '' ORDER BY k) FILTER (k > p AND side = 'rejected'), '') AS rejected,
        coalesce(string_agg((begun + head)::BIGINT || ':' || (begun + length(line) - 1)::BIGINT, ',' ORDER BY k)
            FILTER (k > p AND side = 'chosen' AND role = 'assistant'), '') AS chosen_mask,
        coalesce(string_agg((begun + head)::BIGINT || ':' || (begun + length(line) - 1)::BIGINT, ',' ORDER BY k)
            FILTER (k > p AND side = 'rejected' AND role = 'assistant'), '') AS rejected_mask
    FROM placed GROUP BY conv_id
    """
)
def op7_preference_format(spark, sf_dir):
    """Each conversation is chosen. Its first ``id mod size`` turns and the later ones of its neighbour are rejected.

    Neighbours are ids 2k and 2k + 1, so that pairs part early or late and differ in length. Without a
    neighbour nothing follows the shared turns: the rejected completion is empty.
    """
    own = preference.turns_of(table(spark, sf_dir, "conversations")).toDF("pair_id", "chosen")
    other = own.select(F.col("pair_id").bitwiseXOR(F.lit(1)).alias("pair_id"), F.col("chosen").alias("other"))
    shared = F.pmod("pair_id", F.size("chosen")).cast("int")
    later = F.coalesce(F.slice("other", shared + 1, F.greatest(F.size("other") - shared, F.lit(0))), F.slice("chosen", 1, 0))
    pairs = own.join(other, "pair_id", "left").withColumn("rejected", F.concat(F.slice("chosen", F.lit(1), shared), later))
    formatted = preference.format_pairs(pairs)
    listed = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",").alias(c)
    return formatted.select("pair_id", "prompt_turns", "prompt", "chosen", "rejected", listed("chosen_mask"), listed("rejected_mask"))


@book.add(
    """
    WITH RECURSIVE v AS (
        SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
        WHERE label IS NOT NULL AND list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) > 0
    ), pair AS (
        SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
        WHERE list_cosine_similarity(a.e, b.e) >= 0.98
    ), reach(x, y) AS (
        SELECT vec_id, vec_id FROM embeddings UNION SELECT r.x, p.y FROM reach r JOIN pair p ON r.y = p.x
    ), named AS (SELECT x AS vec_id, min(y) AS component_id FROM reach GROUP BY x),
    linked AS (SELECT x AS vec_id, count(*) AS n FROM pair GROUP BY x)
    SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
    FROM named LEFT JOIN linked USING (vec_id)
    """
)
def op8_embedding_dedup(spark, sf_dir):
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"), 0.98)


@book.add()
def op9_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@book.add()
def op10_order_minhash(spark, sf_dir):
    return order_minhash.near_duplicates(table(spark, sf_dir, "documents"), 0.8)


def _entry(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen({column}::VARCHAR) || ':' || {column}::VARCHAR END"


#: CRC-32 of a decimal number, bit by bit: each character is followed by eight shifts.
CRC32 = (
    "xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''), "
    "lambda x: list_concat([ord(x)::BIGINT], [-1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])))), "
    "lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END), 4294967295)"
)


@book.add(
    f"""
    WITH RECURSIVE leaves AS (
        SELECT doc_id, source, {" || ".join(_entry(c) for c in ("doc_id", "source", "lang", "n_chars"))} AS head, text,
            {CRC32} % 2 = 0 AS torn FROM documents
    ), hashed AS (
        SELECT doc_id, source, sha256(head || {_entry("text")}) AS leaf,
            CASE WHEN torn THEN sha256(head || {_entry("replace(text, chr(10), '')")}) ELSE sha256(head || {_entry("text")}) END AS changed
        FROM leaves
    ), placed AS (
        SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS place, count(*) OVER (PARTITION BY source) AS n FROM hashed
    ), tree(source, level, place, n, digest) AS (
        SELECT source, 0, place, n, leaf FROM placed
        UNION ALL
        SELECT source, level + 1, place // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY place)) FROM tree WHERE n > 1
        GROUP BY source, level, place // 3, n
    ), subroots AS (
        SELECT source, level AS height, digest AS subroot, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS place, count(*) OVER () AS n
        FROM tree WHERE n = 1
    ), forest(level, place, n, digest) AS (
        SELECT 0, place, n, subroot FROM subroots
        UNION ALL
        SELECT level + 1, place // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY place)) FROM forest WHERE n > 1
        GROUP BY level, place // 3, n
    ), peak AS (SELECT level AS height, digest AS root FROM forest WHERE n = 1),
    steps AS (
        SELECT doc_id, t.level AS step, t.place, p.place // (3 ** t.level)::BIGINT AS own, digest
        FROM placed p JOIN tree t ON t.source IS NOT DISTINCT FROM p.source AND t.n > 1 AND t.place // 3 = p.place // (3 ** (t.level + 1))::BIGINT
        UNION ALL
        SELECT doc_id, s.height + f.level, f.place, s.place // (3 ** f.level)::BIGINT, digest
        FROM placed p JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source
        JOIN forest f ON f.n > 1 AND f.place // 3 = s.place // (3 ** (f.level + 1))::BIGINT
    ), proof AS (SELECT doc_id, sha256(coalesce(string_agg(digest, '' ORDER BY step, place) FILTER (place <> own), '')) AS proof_sha256 FROM steps GROUP BY doc_id),
    fold(doc_id, step, digest) AS (
        SELECT doc_id, 0, changed FROM placed
        UNION ALL
        SELECT f.doc_id, f.step + 1, sha256(string_agg(CASE WHEN s.place = s.own THEN f.digest ELSE s.digest END, '' ORDER BY s.place))
        FROM fold f JOIN steps s ON s.doc_id = f.doc_id AND s.step = f.step GROUP BY f.doc_id, f.step
    )
    SELECT p.doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, f.digest AS folded_root, f.digest = root AS verified
    FROM placed p JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source CROSS JOIN peak
    LEFT JOIN proof USING (doc_id) JOIN fold f ON f.doc_id = p.doc_id AND f.step = s.height + peak.height
    """
)
def op11_merkle_manifest(spark, sf_dir):
    proofs = merkle.documents(table(spark, sf_dir, "documents"))
    return proofs.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2("siblings", 256).alias("proof_sha256"),
        F.col("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"),
    )


_FOLDED = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"


@book.add(
    f"""
    WITH held AS (SELECT doc_id, unnest({_FOLDED}) AS term FROM documents),
    asked AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_FOLDED}) AS term FROM benchmark) GROUP BY ALL),
    size AS (SELECT doc_id, count(*) AS n FROM held GROUP BY doc_id),
    whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM size),
    counts AS (SELECT doc_id, term, count(*) AS tf FROM held WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
    weight AS (
        SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM counts CROSS JOIN whole GROUP BY term, docs
    ), scored AS (
        SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms))))::BIGINT AS score
        FROM asked JOIN counts USING (term) JOIN weight USING (term) JOIN size USING (doc_id) CROSS JOIN whole GROUP BY ALL
    )
    SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score
    FROM scored WHERE score > 0 QUALIFY rank <= 20
    """
)
def op13_ranked_search(spark, sf_dir):
    return ranking.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 20)


_DECODED = (
    "regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(x, '<[^>]*>', ' ', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), "
    "'&quot;?', '\"', 'g'), '&amp;?', '&', 'g')"
)


@book.add(
    f"""
    WITH cut AS (
        SELECT page_id, url, string_split_regex(regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1), '</?(?:h1|p)>') AS parts FROM pages
    ), read AS (
        SELECT page_id, url, array_to_string(list_filter(list_transform(parts,
            lambda x: trim(regexp_replace({_DECODED}, '[\\s\\x0B\\x1C-\\x1F\\x{{85}}\\p{{Z}}]+', ' ', 'g'))), lambda x: x <> ''), chr(10)) AS text FROM cut
    )
    SELECT page_id, url, text, length(text) AS n_chars FROM read
    """
)
def op12_html_extraction(spark, sf_dir):
    """The SQL takes the pages' one template as known; the operator infers it."""
    return wrappers.extract(table(spark, sf_dir, "pages"))
