"""The operators as queries over the test tables, with production parameters and whole tables."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import (conversations, decontaminate, langid, merkle, neardup, packing, quality_model,
                        quality_rules, secrets, sharding, simhash, tokenfiles, urls)
from larder.llm.common import id_crc, table
from larder.session import scratch_dir

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
WORD_BPE_IDS = 49_408
CAPACITY, PACK_END, FILE_END = 1024, 2, 1
SHARDS = 24

# fixed values: the rules for hosts and paths
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
             ("block", "net/es/"), ("block", "net/fr/")]


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of 1024 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), BYTE_BPE, "blank", PACK_END, CAPACITY)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that overlap with benchmark items, and where."""
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; a quarter of the ids is held out of training."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.pmod(id_crc(), F.lit(4)) == 2
    model = langid.fit(docs.where(~held_out).select("doc_id", "text", "lang"))
    return langid.identify(docs, model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op4_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard, slot and the shard after one more of every document."""
    return sharding.shard(table(spark, sf_dir, "documents"), SHARDS).withColumn("law", F.lit("key"))


def labelled_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, bad of the pages whose url's number names a labelled document.

    A page shows the document that its path ends with; it is bad if that one is of low quality or toxic.
    """
    path = urls.host_and_path(F.col("url"))[1]
    number = F.regexp_extract(path, r"/([0-9]{1,18})(?:[./][^/]*)?$", 1)
    shown = table(spark, sf_dir, "pages").select("page_id", number.alias("number")).where("number <> ''")
    marks = table(spark, sf_dir, "labels").select("doc_id", ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return shown.withColumn("doc_id", F.col("number").cast("bigint")).join(marks, "doc_id").select("page_id", "bad")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url, by the rules and else by its host's path templates."""
    return urls.judge(table(spark, sf_dir, "pages"), labelled_pages(spark, sf_dir), URL_RULES)


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: counts, a digest of the plain spans, all spans."""
    return secrets.digests(secrets.scan(table(spark, sf_dir, "documents")))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under links of two-word shingle sets."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), words=2)


def quality_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; a fifth of the ids is held out of training."""
    docs, held_out = table(spark, sf_dir, "documents"), F.pmod(id_crc(), F.lit(5)) == 0
    model = quality_model.fit(docs, quality_labels(spark, sf_dir).where(~held_out))
    return quality_model.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every document, the base rules and the trees' verdict."""
    docs = table(spark, sf_dir, "documents")
    return quality_rules.assess(docs, quality_rules.fit(docs, quality_labels(spark, sf_dir)))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the written token files say of every document."""
    docs, out = table(spark, sf_dir, "documents"), scratch_dir(spark, "token-files")
    tokenfiles.write(docs, out, WORD_BPE, "word", FILE_END, WORD_BPE_IDS)
    return tokenfiles.read(spark, out)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of the documents by language, checked against rows of which a seventh is altered."""
    docs = table(spark, sf_dir, "documents")
    longer = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("decimal(20,0)")
    parts = lambda n_chars: merkle.hashed(F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text"))
    altered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    rows = docs.select(F.col("lang").cast("string").alias("grp"), "doc_id", parts(F.col("n_chars")).alias("leaf"),
                       F.when(altered, parts(longer)).alias("claimed"))
    return merkle.manifest(rows).select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_sha256(F.col("path")).alias("proof_sha256"),
        "folded_root", "verified")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation, after the damage that its rows' checksums name."""
    return conversations.repair(conversations.damaged(table(spark, sf_dir, "conversations")))


def op13_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and its component under links of at most three bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_best_fit_packing, op2_decontamination, op3_language_id, op4_jump_sharding, op5_url_filter,
    op6_secret_scan, op7_minhash_near_dedup, op8_quality_classifier, op9_quality_rules,
    op10_token_files, op11_merkle_manifest, op12_conversation_repair,
    op13_simhash_near_dedup)}

def _jump_sql(name: str, shards: int) -> str:
    """CTEs that follow a document's jumps among `shards`, one jump each; the last is `name`."""
    advance = "({k}::HUGEINT * 2862933555777941757 + 1) % 18446744073709551616"
    key = "doc_id::HUGEINT + CASE WHEN doc_id < 0 THEN 18446744073709551616 ELSE 0 END"
    steps = [f"{name}_0 AS (SELECT doc_id, -1::BIGINT AS b, 0::BIGINT AS j, {advance.format(k=f'({key})')} AS k FROM documents)"]
    for step in range(1, shards + 1):
        steps.append(f"""{name}_{step} AS (SELECT doc_id, CASE WHEN j < {shards} THEN j ELSE b END AS b,
          CASE WHEN j < {shards} THEN floor((j + 1) * (2147483648e0 / ((k // 8589934592)::DOUBLE + 1)))::BIGINT ELSE j END AS j,
          CASE WHEN j < {shards} THEN {advance.format(k='k')} ELSE k END AS k FROM {name}_{step - 1})""")
    return ",\n".join([*steps, f"{name} AS (SELECT doc_id, b::INTEGER AS shard FROM {name}_{shards})"])


# the checksum byte by byte, with its table of 256 entries made from the polynomial
SHARDING_SQL = f"""WITH entries AS (SELECT list(c ORDER BY n) AS t FROM (
    SELECT n, list_reduce(list_prepend(n::BIGINT, range(8)), lambda c, k:
      CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END) AS c FROM range(256) r(n))),
  bytes AS (SELECT doc_id, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
      lambda x: ('0x' || x)::BIGINT) AS bytes FROM documents),
  sized AS (SELECT doc_id, len(bytes) + 8 AS size, xor(4294967295::BIGINT,
      list_reduce(list_prepend(4294967295::BIGINT, bytes),
        lambda c, b: xor(entries.t[(xor(c, b) & 255) + 1], c >> 8))) AS text_crc32 FROM bytes, entries),
  {_jump_sql('now', SHARDS)},
  {_jump_sql('grown', SHARDS + 1)}
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, now.shard,
  row_number() OVER (PARTITION BY now.shard ORDER BY doc_id) - 1 AS slot, grown.shard AS grown_shard
FROM sized JOIN now USING (doc_id) JOIN grown USING (doc_id)"""

# fixed values of crc32; the table of 256 entries is made from the polynomial
CRC_ENTRIES = """entries AS (SELECT list(c ORDER BY n) AS t FROM (
    SELECT n, list_reduce(list_prepend(n::BIGINT, range(8)), lambda c, k:
      CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END) AS c FROM range(256) r(n)))"""


def _crc_sql(text: str) -> str:
    """Unsigned crc32 of a text, over a query that joins `entries`."""
    listed = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::BIGINT)"
    return f"""xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, {listed}),
      lambda c, b: xor(entries.t[(xor(c, b) & 255) + 1], c >> 8)))"""


def _hashed_sql(*parts: str) -> str:
    return "sha256(" + " || ".join(
        f"coalesce(strlen(({p})::VARCHAR)::VARCHAR || ':' || ({p})::VARCHAR, '-')" for p in parts) + ")"


_FOLD = """CASE WHEN s[1] = 'l' THEN sha256(s[2:] || c) WHEN s[1] = 'r' THEN sha256(c || s[2:]) ELSE sha256(c) END"""

MERKLE_SQL = f"""WITH RECURSIVE {CRC_ENTRIES},
  hashed AS (SELECT doc_id, lang, {_hashed_sql('doc_id', 'source', 'lang', 'n_chars', 'text')} AS leaf,
    CASE WHEN {_crc_sql('doc_id::VARCHAR')} % 7 = 0 THEN
      {_hashed_sql('doc_id', 'source', 'lang', 'n_chars::HUGEINT + 1', 'text')} END AS claimed FROM documents, entries),
  placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY lang) AS n FROM hashed),
  nodes AS (SELECT lang, 0 AS level, pos, n, leaf AS node FROM placed UNION ALL
    SELECT lang, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(node, '' ORDER BY pos))
    FROM nodes WHERE n > 1 GROUP BY lang, level, pos // 2, n),
  subroots AS (SELECT lang, node, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
    FROM nodes WHERE n = 1),
  crown AS (SELECT 0 AS level, pos, n, node FROM subroots UNION ALL
    SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(node, '' ORDER BY pos))
    FROM crown WHERE n > 1 GROUP BY level, pos // 2, n),
  steps AS (
    SELECT p.lang, p.pos, v.level, CASE WHEN s.node IS NULL THEN '-'
      WHEN (p.pos >> v.level) & 1 = 1 THEN 'l' || s.node ELSE 'r' || s.node END AS step
    FROM placed p JOIN (SELECT DISTINCT lang, level FROM nodes WHERE n > 1) v ON p.lang IS NOT DISTINCT FROM v.lang
    LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM p.lang AND s.level = v.level AND s.pos = xor(p.pos >> v.level, 1)
    UNION ALL
    SELECT p.lang, p.pos, 1000 + v.level, CASE WHEN s.node IS NULL THEN '-'
      WHEN (r.pos >> v.level) & 1 = 1 THEN 'l' || s.node ELSE 'r' || s.node END
    FROM placed p JOIN subroots r ON p.lang IS NOT DISTINCT FROM r.lang
    CROSS JOIN (SELECT DISTINCT level FROM crown WHERE n > 1) v
    LEFT JOIN crown s ON s.level = v.level AND s.pos = xor(r.pos >> v.level, 1)),
  paths AS (SELECT lang, pos, list(step ORDER BY level) AS path FROM steps GROUP BY lang, pos),
  proven AS (SELECT p.doc_id, p.leaf, r.node AS subroot, (SELECT node FROM crown WHERE n = 1) AS root,
      coalesce(h.path, []) AS path, coalesce(p.claimed, p.leaf) AS claimed
    FROM placed p JOIN subroots r ON p.lang IS NOT DISTINCT FROM r.lang
    LEFT JOIN paths h ON h.lang IS NOT DISTINCT FROM p.lang AND h.pos = p.pos),
  ended AS (SELECT *, list_reduce(list_prepend(claimed, path), lambda c, s: {_FOLD}) AS folded_root FROM proven)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda s: s[2:]), '')) AS proof_sha256,
  folded_root, folded_root = root AS verified FROM ended"""

# states: 1 start, 2 behind a system turn, 3 behind a user's, 4 behind an assistant's; a vector has a cost for each
_NEXT = "[3, 3, 4, 3][{s}]"
_KEPT = """CASE WHEN kind = 's' AND {s} = 1 THEN 2 WHEN kind = 'u' AND {s} <> 3 THEN 3 WHEN kind = 'a' AND {s} = 3 THEN 4 END"""
_BEFORE = ", ".join(f"least(4 + v[{s}], stay + 3 + v[{_NEXT.format(s=s)}], coalesce(stay + v[{_KEPT.format(s=s)}], 1000000000))"
                    for s in range(1, 5))

REPAIR_SQL = f"""WITH RECURSIVE {CRC_ENTRIES},
  hit AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS how FROM conversations, entries),
  copied AS (SELECT conv_id, turn, k, CASE WHEN how = 4 THEN 'user' ELSE role END AS role,
      CASE WHEN how = 1 THEN '' WHEN how = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM hit, range(2) r(k) WHERE k < CASE WHEN how = 0 THEN 0 WHEN how = 3 THEN 2 ELSE 1 END),
  numbered AS (SELECT *, left(role, 1) AS kind, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
      left(sha256(strlen(role)::VARCHAR || ':' || role || text), 32), k) AS i,
      rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM copied),
  faulty AS (SELECT *, CASE WHEN body = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
      coalesce(lag(kind) OVER (PARTITION BY conv_id ORDER BY i) || kind NOT IN ('su', 'ua', 'au'), false) AS illegal FROM numbered),
  priced AS (SELECT *, CASE fault WHEN 'blank' THEN 1000000 WHEN 'duplicate' THEN 1000000 WHEN 'truncated' THEN 3 ELSE 0 END AS stay FROM faulty),
  counted AS (SELECT c.conv_id, count(p.i) AS n, coalesce(max(p.turn) - min(p.turn) + 1 - count(DISTINCT p.turn), 0) AS gaps,
      count(*) FILTER (p.fault = 'blank') AS blank, count(*) FILTER (p.fault = 'duplicate') AS duplicate,
      count(*) FILTER (p.fault = 'truncated') AS truncated, count(*) FILTER (p.illegal) AS illegal
    FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN priced p ON p.conv_id IS NOT DISTINCT FROM c.conv_id GROUP BY c.conv_id),
  behind AS (SELECT conv_id, n + 1 AS i, [0, 6, 3, 0] AS v FROM counted UNION ALL
    SELECT conv_id, i, [least(x[1], 3 + x[3], 6 + x[4]), least(x[2], 3 + x[3], 6 + x[4]), least(x[3], 3 + x[4]), least(x[4], 3 + x[3])]
    FROM (SELECT p.conv_id, p.i, [{_BEFORE}] AS x FROM behind b JOIN priced p ON p.conv_id IS NOT DISTINCT FROM b.conv_id AND p.i = b.i - 1)),
  walked AS (SELECT conv_id, n, 1::BIGINT AS i, 1 AS s, '' AS audit, []::VARCHAR[] AS lines FROM counted UNION ALL
    SELECT conv_id, n, CASE WHEN edit = 'I' THEN i ELSE i + 1 END, CASE edit WHEN 'D' THEN s WHEN 'K' THEN {_KEPT.format(s='s')} ELSE {_NEXT.format(s='s')} END,
      audit || edit, CASE edit WHEN 'D' THEN lines WHEN 'K' THEN list_append(lines, role || ':' || text)
        ELSE list_append(lines, CASE WHEN s = 3 THEN 'assistant:' ELSE 'user:' END || CASE WHEN edit = 'R' THEN text ELSE '' END) END
    FROM (SELECT w.*, p.kind, p.role, p.text, CASE WHEN 4 + a.v[s] = h.v[s] THEN 'D' WHEN 3 + h.v[{_NEXT.format(s='s')}] = h.v[s] THEN 'I'
        WHEN p.stay + a.v[{_KEPT.format(s='s')}] = h.v[s] THEN 'K' ELSE 'R' END AS edit
      FROM walked w JOIN behind h ON h.conv_id IS NOT DISTINCT FROM w.conv_id AND h.i = w.i
      LEFT JOIN behind a ON a.conv_id IS NOT DISTINCT FROM w.conv_id AND a.i = w.i + 1
      LEFT JOIN priced p ON p.conv_id IS NOT DISTINCT FROM w.conv_id AND p.i = w.i
      WHERE w.i <= w.n OR h.v[s] > 0))
SELECT c.conv_id, gaps::BIGINT AS gaps, blank, duplicate, truncated, illegal, b.v[1]::BIGINT AS cost, w.audit,
  sha256(array_to_string(w.lines, chr(10))) AS repaired_sha256
FROM counted c JOIN walked w ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.i = c.n + 1 AND w.s IN (1, 4)
JOIN behind b ON b.conv_id IS NOT DISTINCT FROM c.conv_id AND b.i = 1"""

# models, tokenizers, spans and sketches aren't SQL; tests/llm has brute-force versions
ORACLE: dict[str, str] = {"op4_jump_sharding": SHARDING_SQL, "op11_merkle_manifest": MERKLE_SQL,
                          "op12_conversation_repair": REPAIR_SQL}
