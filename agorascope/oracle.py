"""DuckDB SQL for the registered queries, written apart from the DataFrame code."""

from __future__ import annotations

from agorascope import vocabulary as V
from agorascope.plans.corpus import FEATURES, STREAM_KINDS, SUB_TAGS

#: White space beyond ASCII, as the text functions define it.
SPACE = r"[\t\n\x0B\f\r \x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _of(values, index: str) -> str:
    return f"({_list(values)})[1 + ({index}) % {len(values)}]"


def normalize(text: str) -> str:
    out = f"lower(coalesce({text}, ''))"
    for pattern, put in ((r"```[\s\S]*?```", " "), ("https?://" + SPACE.replace("[", "[^", 1) + "+", " "), ("&[a-z]{2,8};", " "), ("[*_~`>#|]+", " "), (r"\[([^\]]*)\]\([^)]*\)", r"\1"), ("[0-9]{1,4}([-/][0-9]{1,4}){1,2}", " "), (SPACE + "+", " ")):
        out = f"regexp_replace({out}, '{pattern}', '{put}', 'g')"
    return f"trim({out})"


def hashed(text: str, floor: int) -> str:
    return f"CASE WHEN length({normalize(text)}) >= {floor} THEN substr(sha1({normalize(text)}), 1, 16) END"


WEEK = "year(ts) || '-W' || lpad(CAST(ceil((floor(epoch(ts - date_trunc('year', ts))) / 86400 + dayofweek(date_trunc('year', ts)) + 1) / 7) AS BIGINT)::VARCHAR, 2, '0')"
T = [t for t, _ in V.TOPICS]
SHARE = lambda a, b: f"round(CASE WHEN {b} = 0 THEN 0.0 ELSE ({a})::DOUBLE / ({b}) END, 6)"
AI = V.AI_WORDS.replace("'", "''")

CORPUS = f"""
WITH base AS (
  SELECT d.doc_id, d.text AS body, d.source AS subreddit, e.user_id AS u, e.ts, floor(epoch(e.ts))::BIGINT AS created_utc, CAST(regexp_extract(e.props, '([0-9]+)', 1) AS BIGINT) AS k, d.doc_id // 20 AS q,
    coalesce(l.quality = 1, false) AS good
  FROM documents d JOIN (SELECT event_id, coalesce(user_id, 0) AS user_id, ts, props FROM events) e ON e.event_id = d.doc_id
  LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id) l ON l.doc_id = d.doc_id),
stored AS (
  SELECT *, 'd' || doc_id AS id, substr(string_split(body, chr(10))[1], 1, 200) AS title, CASE WHEN subreddit IN ('src18', 'src19') THEN 'bluesky' ELSE 'reddit' END AS source,
    CASE WHEN q % 17 = 0 THEN 'AutoModerator' WHEN u % 50 = 0 THEN '[deleted]' ELSE 'user' || u END AS author, q % 23 = 0 AS moderator, q % 29 = 0 AS stickied, q % 37 <> 0 AS analyzed, q % 31 <> 0 AS parses,
    (['', 'Critique', 'Discussion', 'Feedback request', 'News'])[1 + k % 5] AS flair, {WEEK} AS week, good OR k % 3 = 0 AS ai_related, {_of(V.STANCES, 'k + q')} AS stance, {_of(V.EXPERIENCE, 'u')} AS experience, (q + k) % 4 AS intensity,
    CASE q % 3 WHEN 0 THEN substr(body, 5, 60) WHEN 1 THEN 'no such words are in the text at all ' || q ELSE '' END AS quote FROM base),
good_rows AS (SELECT *, {hashed('title', 40)} AS title_hash FROM stored WHERE analyzed AND parses),
items AS (
  SELECT *, CASE WHEN reason IN ('automod-author', 'distinguished') THEN 'bot' WHEN reason <> '' THEN 'boilerplate' ELSE 'human' END AS class FROM (
    SELECT *, CASE WHEN author = 'AutoModerator' THEN 'automod-author' WHEN moderator THEN 'distinguished' WHEN stickied THEN 'stickied'
      WHEN title_hash IS NOT NULL AND count(*) OVER (PARTITION BY subreddit, title_hash) > 5 THEN 'repeat-hash' ELSE '' END AS reason FROM good_rows)),
human AS (SELECT * FROM items WHERE class = 'human'),
ai AS (SELECT * FROM human WHERE ai_related),
topics AS (
  SELECT id, 0 AS pos, {_of(T, 'k * 7 + q')} AS topic FROM human UNION ALL SELECT id, 1, {_of(T, 'u + 3 * q')} FROM human UNION ALL SELECT id, 2, 'unknown-topic' FROM human WHERE k % 4 = 0),
ai_topics AS (SELECT a.*, t.topic FROM topics t JOIN ai a USING (id)),
pains AS (SELECT subreddit, id, 0 AS pos, 'pain ' || (k % 13) AS pain FROM human UNION ALL SELECT subreddit, id, 1, 'pain ' || (q % 11) FROM human WHERE k % 2 = 0),
tools AS (SELECT *, 'Tool' || (u % 12) AS tool, (['positive', 'negative', 'mixed', 'neutral', 'neutral'])[1 + k % 5] AS sentiment, q % 6 = 0 AS switching FROM human),
deals AS (SELECT subreddit, id, CASE WHEN k % 3 = 0 THEN 'ITEM ' || (q % 8) ELSE 'item ' || (q % 8) END AS item, {_of(V.DEALBREAKER_KINDS, 'k')} AS kind, 'deal quote number ' || q || ' of them' AS quote FROM human WHERE k % 2 = 1),
trust AS (SELECT subreddit, id, 'signal ' || (q % 7) AS signal, (['builds', 'breaks', 'sideways'])[1 + k % 3] AS direction, 'trust quote ' || (q % 5) AS quote FROM human),
features AS (SELECT subreddit, id, {_of(FEATURES, 'k')} AS feature FROM human WHERE q % 2 = 0),
framed AS (SELECT *, CASE WHEN source = 'bluesky' THEN 'bluesky-' || CASE subreddit {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in STREAM_KINDS.items())} ELSE 'untagged' END
  ELSE CASE subreddit {' '.join(f"WHEN '{k}' THEN 'reddit-{v}'" for k, v in SUB_TAGS.items())} ELSE 'reddit' END END AS frame FROM ai),
claims AS (SELECT id, 'topic' AS claim, topic AS name FROM topics UNION ALL SELECT id, 'pain', pain FROM pains),
recurrence AS (SELECT claim, name, count(DISTINCT id) AS threads FROM claims GROUP BY ALL),
salience AS (SELECT id, sum(threads)::BIGINT AS salience FROM claims JOIN recurrence USING (claim, name) GROUP BY id),
observed AS (SELECT week, row_number() OVER (ORDER BY week DESC) - 1 AS back FROM (SELECT DISTINCT week FROM human WHERE week <> '')),
talk AS (
  SELECT 'c_' || conv_id || '_' || turn AS row_key, 'd' || conv_id AS id, 'src' || (conv_id % 20) AS subreddit, conv_id, turn, role, text AS body, length(text) AS body_chars,
    regexp_matches(text, '(?i)(^|[^A-Za-z0-9_])({AI})($|[^A-Za-z0-9_])') AS ai_hit, turn % 3 = 2 AS is_reply FROM conversations),
body_repeats AS (SELECT subreddit, h, count(*) AS n FROM (SELECT subreddit, {hashed('body', 120)} AS h FROM talk) WHERE h IS NOT NULL GROUP BY ALL),
judged AS (SELECT *, CASE role WHEN 'assistant' THEN 'automod-author' WHEN 'system' THEN 'stickied' END AS reason FROM talk),
needles AS (
  SELECT id, subreddit, pos, field, {normalize('quote')} AS needle FROM (
    SELECT id, subreddit, 0 AS pos, 'notable_quote' AS field, quote FROM items UNION ALL
    SELECT id, subreddit, 1, 'deal_breakers', 'deal quote number ' || q || ' of them' FROM items WHERE k % 2 = 1)
  WHERE length({normalize('quote')}) >= 25),
said AS (SELECT id, reason, {normalize('body')} AS said FROM judged),
provenance AS (
  SELECT n.id, n.subreddit, n.pos, n.field, CASE WHEN strpos({normalize('s.body')}, needle) > 0 THEN 'post-body' WHEN EXISTS (SELECT 1 FROM said c WHERE c.id = n.id AND reason IS NULL AND strpos(said, needle) > 0) THEN 'human-comment'
    WHEN EXISTS (SELECT 1 FROM said c WHERE c.id = n.id AND reason IS NOT NULL AND strpos(said, needle) > 0) THEN 'bot-comment' ELSE 'not-found' END AS bucket
  FROM needles n JOIN stored s USING (id)),
by_author AS (SELECT author, count(*) AS posts, count(*) FILTER (ai_related) AS ai_posts, count(DISTINCT subreddit) AS subs FROM items GROUP BY author),
weekly AS (SELECT week, count(*) AS n FROM items WHERE ai_related AND week <> '' GROUP BY week)
"""


def _board(source: str, key: str, where: str = "true") -> str:
    return f"SELECT {key}, count(*) AS n FROM {source} WHERE {where} GROUP BY {key}"


def _tail(source: str, key: str) -> str:
    return f"SELECT {key}, n, (SELECT count(DISTINCT {key}) FROM {source}) AS distinct_total FROM (SELECT {key}, count(*) AS n, min(subreddit || '/' || id) AS s FROM {source} GROUP BY {key}) ORDER BY n DESC, s LIMIT 400"


def _examples(source: str, keys: str) -> str:
    return f"SELECT {keys}, string_agg(quote, ' | ' ORDER BY r) AS examples FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY subreddit, id) AS r FROM {source}) WHERE r <= 3 GROUP BY {keys}"


_RESONANCE = " + ".join([f"{p} * (list_contains(tps, '{t}'))::INT" for t, p, _ in V.RESONANCE_TOPICS] + [f"2 * (regexp_matches(pool, '(?i){p}'))::INT" for p in V.PILLARS.values()])
_HITS = ", ".join([f"CASE WHEN list_contains(tps, '{t}') THEN '{label}' END" for t, _, label in V.RESONANCE_TOPICS] + [f"CASE WHEN regexp_matches(pool, '(?i){p}') THEN '{name}' END" for name, p in V.PILLARS.items()])
_STOP = " + ".join(f"(strpos(w, ' {x} ') > 0)::INT" for x in V.ENGLISH_STOPWORDS)
_TRIMMED = f"regexp_replace(coalesce(body, ''), '^{SPACE}+|{SPACE}+$', '', 'g')"

SELECTS = {
    "normalize_hash": f"SELECT doc_id, {hashed('body', 120)} AS hash, length({normalize('body')}) AS n_normalized FROM base",
    "week_key_counts": f"SELECT {WEEK} AS week, count(*) AS n FROM events GROUP BY 1",
    "sub_mentions": r"SELECT page_id, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i AND x <> 'sub_3')[1:30], ',') AS mentions FROM (SELECT page_id, list_transform(regexp_extract_all(url || ' r/' || h || ' r/' || upper(h) || array_to_string(list_transform(range(0, page_id % 40 + 1), lambda i: ' see r/Sub_' || i), ','), '\br/([A-Za-z0-9_]{3,21})\b', 1), lambda m: lower(m)) AS l FROM (SELECT page_id, url, regexp_replace(split_part(split_part(url, '://', 2), '/', 1), '[^A-Za-z0-9]', '_', 'g') AS h FROM pages))",
    "ai_prefilter": "SELECT role, count(*) FILTER (ai_hit) AS n_hit, count(*) AS n FROM talk GROUP BY role",
    "non_english_by_lang": f"SELECT lang, count(*) AS n, count(*) FILTER (length(t) >= 40 AND ({_STOP}) < 2) AS non_english FROM (SELECT lang, t, ' ' || substr(t, 1, 200) || ' ' AS w FROM (SELECT lang, {normalize('text')} AS t FROM documents)) GROUP BY lang",
    "empty_or_removed": f"SELECT subreddit, count(*) FILTER (length({_TRIMMED}) < 20 OR lower({_TRIMMED}) IN ('[removed]', '[deleted]')) AS n FROM base GROUP BY subreddit",
    "vector_base64": "SELECT vec_id, len(embedding) AS n, len(embedding) AS n_equal, round(list_sum(embedding::DOUBLE[]), 3) AS total FROM embeddings",
    "embedding_cosine_top": "SELECT vec_id, round(list_dot_product(embedding::DOUBLE[], (SELECT embedding FROM embeddings WHERE vec_id = 0)::DOUBLE[]) / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) / (SELECT sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) FROM embeddings WHERE vec_id = 0), 5) AS similarity FROM embeddings ORDER BY similarity DESC, vec_id LIMIT 100",
    "parse_skipped": "SELECT parses AS valid, count(*) AS n FROM stored WHERE analyzed GROUP BY parses",
    "meta_counts": "SELECT count(*) FILTER (class = 'human') AS total_posts, count(*) AS total_rows, count(*) FILTER (class = 'human' AND ai_related) AS ai_related, count(*) FILTER (class <> 'human') AS non_human, count(*) FILTER (class = 'bot') AS bot, count(*) FILTER (class = 'boilerplate') AS boilerplate, count(*) FILTER (class = 'human') AS submissions, 0::BIGINT AS comments, count(DISTINCT subreddit) FILTER (class = 'human') AS subreddits, count(DISTINCT week) FILTER (class = 'human') AS weeks FROM items",
    "content_class_counts": "SELECT class AS content_class, reason, count(*) AS n FROM items WHERE class <> 'human' GROUP BY ALL",
    "classify_with_bodies": f"SELECT r AS reason, count(*) AS n FROM (SELECT CASE WHEN author = 'AutoModerator' THEN 'automod-author' WHEN moderator THEN 'distinguished' WHEN stickied THEN 'stickied' WHEN (th IS NOT NULL AND count(*) OVER (PARTITION BY subreddit, th) > 1) OR (bh IS NOT NULL AND count(*) OVER (PARTITION BY subreddit, bh) > 1) THEN 'repeat-hash' ELSE '' END AS r FROM (SELECT *, {hashed('title', 40)} AS th, {hashed('body', 120)} AS bh FROM stored)) GROUP BY r",
    "heatmap_topic_week": f"SELECT t.topic, a.week, count(a.id) AS n FROM (SELECT unnest({_list(T)}) AS topic) t LEFT JOIN ai_topics a ON a.topic = t.topic GROUP BY ALL",
    "heatmap_sub_topic": "SELECT subreddit, topic, count(*) AS n FROM ai_topics GROUP BY ALL",
    "stance_by_week": "SELECT week, stance, count(*) AS n FROM ai GROUP BY ALL",
    "dist_stance": _board("ai", "stance"),
    "dist_experience": _board("ai", "experience"),
    "dist_source_stance": "SELECT source, stance, count(*) AS n FROM ai GROUP BY ALL",
    "dist_topics": _board("ai_topics", "topic"),
    "dist_tools_top": _tail("(SELECT * FROM tools WHERE ai_related)", "tool"),
    "dist_pains_top": _tail("(SELECT p.* FROM pains p JOIN ai USING (id))", "pain"),
    "minbar_baseline": _tail("(SELECT subreddit, id, 'baseline ' || (u % 9) AS baseline FROM human)", "baseline"),
    "minbar_dealbreakers": f"SELECT b.item, b.kind, n, examples FROM (SELECT lower(item) AS key, count(*) AS n, arg_min(item, subreddit || '/' || id) AS item, arg_min(kind, subreddit || '/' || id) AS kind FROM deals GROUP BY 1) b JOIN ({_examples('(SELECT *, lower(item) AS key FROM deals)', 'key')}) USING (key)",
    "minbar_kinds": _board("deals", "kind"),
    "trust_board": f"SELECT direction, rank, signal, n, examples FROM (SELECT *, row_number() OVER (PARTITION BY direction ORDER BY n DESC, s) AS rank FROM (SELECT direction, signal, count(*) AS n, min(subreddit || '/' || id) AS s FROM trust WHERE direction <> 'sideways' GROUP BY ALL)) JOIN ({_examples('trust', 'direction, signal')}) USING (direction, signal) WHERE rank <= 20",
    "features_board": "SELECT lower(feature) AS feature, count(*) AS n FROM features GROUP BY 1",
    "competitors_board": "SELECT tool, count(*) AS mentions, count(*) FILTER (sentiment = 'positive') AS positive, count(*) FILTER (sentiment = 'negative') AS negative, count(*) FILTER (sentiment = 'mixed') AS mixed, count(*) FILTER (sentiment = 'neutral') AS neutral, count(*) FILTER (switching) AS switching FROM tools GROUP BY tool",
    "switching_moments": "SELECT tool, 'context ' || q AS context, '/r/' || subreddit || '/' || doc_id AS permalink, subreddit, week FROM tools WHERE switching ORDER BY subreddit, id LIMIT 40",
    "recurrence": "SELECT claim, name, threads FROM recurrence",
    "salience_rows": "SELECT id, salience FROM salience",
    "quotes_top": "SELECT id, quote, stance, experience, (SELECT string_agg(topic, ',' ORDER BY pos) FROM topics t WHERE t.id = ai.id) AS topics, title, subreddit, '/r/' || subreddit || '/' || doc_id AS permalink, week, 'post' AS kind, salience FROM ai JOIN salience USING (id) WHERE quote <> '' ORDER BY salience DESC, created_utc, id LIMIT 400",
    "resonance_top": f"SELECT id, fit, hits, title, quote, '/r/' || subreddit || '/' || doc_id AS permalink, subreddit, 'post' AS kind, salience, k::INT AS score_at_capture, stance, experience, week, count(*) OVER () AS total_matching FROM (SELECT *, ({_RESONANCE})::BIGINT AS fit, array_to_string(list_filter([{_HITS}], lambda h: h IS NOT NULL), ',') AS hits FROM (SELECT h.*, t.tps, concat_ws(' | ', f.feature, 'Signal ' || (q % 7), 'Pain ' || (k % 13), CASE WHEN k % 2 = 0 THEN ' pain ' || (q % 11) || ' ' END, quote) AS pool FROM human h JOIN (SELECT id, list(topic) AS tps FROM topics GROUP BY id) t USING (id) LEFT JOIN features f USING (id))) JOIN salience USING (id) WHERE fit >= 4 ORDER BY fit DESC, salience DESC, subreddit, id LIMIT 50",
    "topic_spikes": f"SELECT topic, label, cur AS this_week, round(mean, 1) AS trailing_mean, round(cur / greatest(mean, 1.0), 1) AS ratio FROM (SELECT t.topic, t.label, count(a.id) FILTER (o.back = 0) AS cur, count(a.id) FILTER (o.back BETWEEN 1 AND 4) / 4.0 AS mean FROM (SELECT unnest({_list(T)}) AS topic, unnest({_list([x for _, x in V.TOPICS])}) AS label) t LEFT JOIN (SELECT *, CASE WHEN k % 4 <> 0 THEN 0 ELSE 4 - q % 4 END AS back FROM ai_topics) a ON a.topic = t.topic CROSS JOIN LATERAL (SELECT a.back) o GROUP BY ALL) WHERE cur >= 5 AND cur >= 2 * greatest(mean, 1.0)",
    "discovery_candidates": f"SELECT sub, count(*) AS mentions, array_to_string(list_slice(list_sort(list_distinct(list(subreddit))), 1, 6), ',') AS cited_by FROM (SELECT subreddit, 'sub' || (k % 15) AS sub FROM human WHERE q % 4 = 0 UNION ALL SELECT subreddit, 'sub' || (conv_id % 20) FROM talk WHERE turn % 2 = 0 UNION ALL SELECT subreddit, 'src' || (conv_id % 20) FROM talk WHERE turn % 2 = 0) WHERE sub NOT IN ('sub1', 'sub2') AND sub NOT IN (SELECT subreddit FROM human) GROUP BY sub HAVING count(*) >= 3 ORDER BY mentions DESC, sub LIMIT 40",
    "rules_by_sub": "SELECT subreddit, reason, count(*) AS n FROM items WHERE class <> 'human' GROUP BY ALL",
    "rules_samples": f"SELECT subreddit, first_id, text FROM (SELECT *, row_number() OVER (PARTITION BY subreddit ORDER BY first_id, text) AS r FROM (SELECT subreddit, trim(CASE WHEN quote <> '' THEN quote ELSE 'summary ' || doc_id END, ' ') AS text, min(id) AS first_id FROM items WHERE class <> 'human' GROUP BY ALL) WHERE text <> '') WHERE r <= 5",
    "author_modal_stance": "SELECT frame, author, stance FROM (SELECT *, row_number() OVER (PARTITION BY frame, author ORDER BY n DESC, s) AS r FROM (SELECT frame, author, stance, count(*) AS n, min(subreddit || '/' || id) AS s FROM framed WHERE author <> '[deleted]' GROUP BY ALL)) WHERE r = 1",
    "cohort_basis_counts": f"SELECT frame, stance, basis, count(*) AS n FROM (SELECT frame, stance, unnest([{_of(V.STANCE_BASIS, 'k + q')}, {_of(V.STANCE_BASIS, 'u')}]) AS basis FROM framed WHERE stance IN ('hostile', 'wary', 'conflicted')) GROUP BY ALL",
    "comment_stance_mix": "SELECT frame, stance, sum(n)::BIGINT AS n FROM (SELECT frame, 'hostile' AS stance, k % 4 AS n FROM framed WHERE k % 5 = 0 UNION ALL SELECT frame, 'curious', q % 3 FROM framed WHERE k % 5 = 0) GROUP BY ALL",
    "audit_author_top20": "SELECT author, posts, ai_posts, subs FROM by_author ORDER BY ai_posts DESC, posts DESC, author LIMIT 20",
    "audit_author_concentration": f"SELECT total_authors, total_ai, {SHARE('sum(ai_posts) FILTER (r <= greatest(1, ceil(total_authors * 0.01)))', 'total_ai')} AS top1_share, {SHARE('sum(ai_posts) FILTER (r <= greatest(1, ceil(total_authors * 0.1)))', 'total_ai')} AS top10_share FROM (SELECT ai_posts, row_number() OVER (ORDER BY ai_posts DESC, posts DESC) AS r, count(*) OVER () AS total_authors, (sum(ai_posts) OVER ())::BIGINT AS total_ai FROM by_author) GROUP BY total_authors, total_ai",
    "audit_sub_concentration": f"SELECT subreddit, tag, n, {SHARE('(sum(n) FILTER (starts_with(tag, $$enclave$$)) OVER ())', '(sum(n) OVER ())')} AS enclave_share FROM (SELECT subreddit, CASE subreddit {' '.join(f'WHEN {k!r} THEN {v!r}' for k, v in SUB_TAGS.items())} ELSE 'population' END AS tag, count(*) AS n FROM items WHERE ai_related GROUP BY ALL)",
    "audit_week_spikes": "SELECT week, n, (SELECT median(n) FROM weekly) AS median, n > 3 * (SELECT median(n) FROM weekly) AS spike, week < '2019-W01' AS stray FROM weekly",
    "audit_stance_coherence": "SELECT count(*) FILTER (stance <> 'na' AND NOT ai_related) AS strong_not_ai, count(*) FILTER (stance = 'na' AND ai_related) AS ai_no_stance, count(*) AS total FROM items",
    "audit_detection_coverage": "SELECT *, bot = 0 AND boilerplate = 0 AS zero_detection FROM (SELECT subreddit, count(*) AS total, count(*) FILTER (class = 'bot') AS bot, count(*) FILTER (class = 'boilerplate') AS boilerplate, count(*) FILTER (class = 'human') AS human FROM items GROUP BY subreddit)",
    "audit_flair": "SELECT subreddit, CASE WHEN flair = '' THEN '(none)' ELSE flair END AS flair, count(*) AS n, count(*) FILTER (flair IN ('Critique', 'Feedback request')) AS critique FROM items GROUP BY ALL",
    "audit_critique_sample": "SELECT subreddit, id, flair, stance FROM items WHERE flair IN ('Critique', 'Feedback request') ORDER BY subreddit, id LIMIT 30",
    "audit_body_stats": f"SELECT subreddit, count(*) AS n, sum(length(body))::BIGINT AS chars, count(*) FILTER (length({_TRIMMED}) < 20 OR lower({_TRIMMED}) IN ('[removed]', '[deleted]')) AS empty, count(*) FILTER (length(t) >= 40 AND ({_STOP}) < 2) AS non_english FROM (SELECT *, ' ' || substr(t, 1, 200) || ' ' AS w FROM (SELECT subreddit, body, {normalize('body')} AS t FROM stored)) GROUP BY subreddit",
    "audit_duplicates": f"SELECT kind, count(*) AS hashes, sum(n)::BIGINT AS rows FROM (SELECT CASE WHEN count(DISTINCT subreddit) > 1 THEN 'crosspost' ELSE 'repost' END AS kind, count(*) AS n FROM (SELECT subreddit, {hashed('body', 120)} AS h FROM stored) WHERE h IS NOT NULL GROUP BY h HAVING count(*) > 1) GROUP BY kind",
    "audit_quote_provenance": "SELECT field, bucket, count(*) AS n FROM provenance GROUP BY ALL",
    "contamination_by_sub": "SELECT subreddit, count(*) AS eligible, count(*) FILTER (broad) AS broad, count(*) FILTER (narrow) AS narrow FROM (SELECT i.id, i.subreddit, bool_or(c.reason IS NOT NULL) AS broad, coalesce(bool_or(EXISTS (SELECT 1 FROM needles n JOIN said s ON s.id = n.id WHERE n.id = i.id AND s.reason IS NOT NULL AND strpos(s.said, n.needle) > 0)), false) AS narrow FROM items i JOIN judged c ON c.id = i.id GROUP BY ALL) GROUP BY subreddit",
    "retag_report": f"SELECT old_reason, reason AS new_reason, count(*) AS n FROM (SELECT '' AS old_reason, CASE WHEN author = 'AutoModerator' THEN 'automod-author' WHEN moderator THEN 'distinguished' WHEN stickied THEN 'stickied' WHEN th IS NOT NULL AND count(*) OVER (PARTITION BY subreddit, th) > 5 THEN 'repeat-hash' ELSE '' END AS reason FROM (SELECT *, {hashed('title', 40)} AS th FROM stored)) GROUP BY ALL",
    "registry_hashes": f"SELECT subreddit AS sub, h AS hash, max(n) AS repeats, max(kind) AS kind FROM (SELECT subreddit, h, n, 'comment-body' AS kind FROM body_repeats WHERE n > 1 UNION ALL SELECT subreddit, h, count(*), 'title' FROM (SELECT subreddit, {hashed('title', 40)} AS h FROM stored) WHERE h IS NOT NULL GROUP BY ALL HAVING count(*) > 1) GROUP BY ALL",
    "comment_filter_reasons": f"SELECT reason, count(*) AS n FROM (SELECT CASE WHEN j.reason IS NOT NULL THEN j.reason WHEN b.n > 1 THEN 'registry-hash' END AS reason FROM (SELECT *, {hashed('body', 120)} AS h FROM judged) j LEFT JOIN body_repeats b ON b.subreddit = j.subreddit AND b.h = j.h) GROUP BY reason",
    "comment_policy_dry_run": "SELECT reason, reason IN ('parent-ai-related', 'long-and-ai-mentioning') AS selected, count(*) AS n FROM (SELECT CASE WHEN coalesce(s.ai_related, false) THEN 'parent-ai-related' WHEN body_chars >= 400 AND ai_hit THEN 'long-and-ai-mentioning' WHEN body_chars < 400 THEN 'too-short' ELSE 'no-ai-mention' END AS reason FROM talk t LEFT JOIN items s ON s.id = t.id) GROUP BY ALL",
    "comments_first20": "SELECT id AS link_id, row_key, rank AS position FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY turn, row_key) AS rank FROM talk WHERE NOT is_reply) WHERE rank <= 20",
    "ingest_dedupe": "SELECT subreddit, id AS row_key, created_utc + 5 AS created_utc, 'newest' AS title FROM stored WHERE q % 2 = 1",
    "upsert_merge": "SELECT CASE WHEN q % 2 = 0 THEN false ELSE true END AS is_new, count(*) AS n, sum(length(title))::BIGINT AS title_chars, count(*) FILTER (q % 2 = 0 AND q % 37 <> 0) AS analyzed FROM stored GROUP BY 1",
    "backfill_watermarks": "SELECT subreddit, 'post' AS kind, max(created_utc) AS watermark, count(*) AS n FROM stored GROUP BY subreddit",
    "daily_cap_admission": "SELECT id AS row_key, created_utc FROM stored WHERE NOT analyzed ORDER BY created_utc, id LIMIT 15",
    "ask_recency_top": "SELECT id, created_utc, stance FROM items WHERE ai_related AND stance = 'wary' ORDER BY created_utc DESC, id LIMIT 300",
    "reanalyze_selection": "SELECT id AS row_key FROM stored WHERE subreddit = 'src5' AND q % 37 <> 0 ORDER BY id LIMIT 100",
    "health_counts": "SELECT count(*) AS posts, count(*) FILTER (analyzed) AS analyzed, count(*) FILTER (NOT analyzed) AS pending, (SELECT count(*) FROM talk) AS comments FROM stored",
    "export_rows": f"SELECT id, subreddit, title, author, 'post' AS kind, NULL::VARCHAR AS link_id, NULL::VARCHAR AS parent_id, k::INT AS score_at_capture, u::INT AS num_comments_at_capture, created_utc, '/r/' || subreddit || '/' || doc_id AS permalink, nullif(flair, '') AS flair, {V.SCHEMA_VERSION} AS schema_version, '' AS emb, parses, CASE WHEN parses THEN week END AS week FROM stored WHERE analyzed",
    "snapshot_headline": "SELECT (SELECT count(*) FROM items) AS total_rows, (SELECT count(*) FROM items WHERE ai_related) AS ai_rows, stance, count(*) AS n FROM ai GROUP BY stance",
}
_FIELDS = "SELECT doc_id, 'title' AS key, substr(string_split(text, chr(10))[1], 1, 200) AS value FROM documents UNION ALL SELECT doc_id, 'body', text FROM documents UNION ALL SELECT doc_id, 'lang', lang FROM documents"
_COSINE = "list_dot_product(e.embedding::DOUBLE[], t.embedding::DOUBLE[]) / sqrt(list_dot_product(e.embedding::DOUBLE[], e.embedding::DOUBLE[])) / sqrt(list_dot_product(t.embedding::DOUBLE[], t.embedding::DOUBLE[]))"
SELECTS |= {
    "registry_summary": f"SELECT sub, kind, count(*) AS hashes, max(repeats) AS most FROM ({SELECTS['registry_hashes']}) GROUP BY ALL",
    "filtered_last_day": "SELECT reason, count(*) AS n FROM judged WHERE reason IS NOT NULL AND turn IN (4, 5) GROUP BY reason",
    "keyset_page": "SELECT subreddit, id AS row_key FROM stored WHERE subreddit > 'src3' OR (subreddit = 'src3' AND id > 'd5') ORDER BY subreddit, id LIMIT 50",
    "row_keys": "SELECT 'post' AS kind, count(*) AS n, count(*) AS round_trips FROM stored UNION ALL SELECT 'comment', count(*), count(*) FROM talk",
    "payload_chunks": "SELECT doc_id, greatest(1, (n + 999) // 1000)::BIGINT AS n_chunks, (n - 1000 * (greatest(1, (n + 999) // 1000) - 1))::BIGINT AS last_chars, true AS whole FROM (SELECT doc_id, length(coalesce(text, '')) AS n FROM documents)",
    "payload_shrunk": f"SELECT doc_id, coalesce(string_agg(key, ',' ORDER BY key) FILTER (upto <= 2000), '') AS kept, coalesce(string_agg(key, ',' ORDER BY key) FILTER (upto > 2000), '') AS dropped FROM (SELECT doc_id, key, sum(coalesce(length(value), 0)) OVER (PARTITION BY doc_id ORDER BY coalesce(length(value), 0), key) AS upto FROM ({_FIELDS})) GROUP BY doc_id",
    "ask_similarity_top": f"SELECT i.id, round({_COSINE}, 5) AS similarity FROM items i JOIN embeddings e ON i.id = 'd' || e.vec_id, (SELECT embedding FROM embeddings WHERE vec_id = 0) t WHERE i.ai_related ORDER BY {_COSINE} DESC, i.id LIMIT 50",
}
_MEMBERS = "SELECT 'group ' || g AS canonical, spot, CASE WHEN spot = 2 THEN 9000 ELSE g + 7 * spot END AS member, 14 - g AS n FROM range(7) t(g), range(14) w(spot) WHERE spot <= 13 - g"
SELECTS |= {
    "meta_lists": "SELECT (SELECT string_agg(s, ',' ORDER BY s) FROM (SELECT DISTINCT subreddit AS s FROM human)) AS subreddits, (SELECT string_agg(w, ',' ORDER BY w) FROM (SELECT DISTINCT week AS w FROM human WHERE week <> '')) AS weeks",
    "persona_sample": "SELECT id, stance, experience, 'summary ' || doc_id AS summary, quote FROM ai JOIN salience USING (id) ORDER BY salience DESC, created_utc, id LIMIT 200",
    "features_clustered": f"SELECT canonical, n, 2 * count(*) FILTER (f.id IS NOT NULL AND u % 2 = 0) >= count(f.id) AND count(f.id) > 0 AS ai_related, coalesce(string_agg('want ' || q, ' | ' ORDER BY spot) FILTER (r <= 3), '') AS examples FROM (SELECT m.*, f.id, h.u, h.q, row_number() OVER (PARTITION BY canonical, f.id IS NULL ORDER BY spot) + CASE WHEN f.id IS NULL THEN 1000 ELSE 0 END AS r FROM ({_MEMBERS}) m LEFT JOIN (SELECT id, row_number() OVER (ORDER BY subreddit, id) - 1 AS member FROM features ORDER BY subreddit, id LIMIT 400) f USING (member) LEFT JOIN human h ON h.id = f.id) f GROUP BY canonical, n ORDER BY n DESC, canonical LIMIT 40",
    "audit_top_duplicates": f"SELECT h AS hash, count(*) AS n, count(DISTINCT subreddit) AS subs, CASE WHEN count(DISTINCT subreddit) > 1 THEN 'crosspost' ELSE 'repost' END AS kind FROM (SELECT subreddit, {hashed('body', 120)} AS h FROM stored) WHERE h IS NOT NULL GROUP BY h HAVING count(*) > 1 ORDER BY n DESC, h LIMIT 20",
    "audit_missing_bodies": "SELECT subreddit, count(*) FILTER (q % 7 <> 0) AS read, count(*) FILTER (q % 7 = 0) AS missing FROM items GROUP BY subreddit",
    "audit_quote_sample": "SELECT subreddit, bucket, id, pos::INT AS pos, seen FROM (SELECT *, row_number() OVER (PARTITION BY subreddit, bucket ORDER BY sha1(id || '|' || pos), id, pos) AS r, count(*) OVER (PARTITION BY subreddit, bucket) AS seen FROM provenance) WHERE r <= 5",
    "retag_saved": SELECTS["retag_report"].replace("SELECT old_reason, reason AS new_reason, count(*) AS n FROM", "SELECT CASE WHEN reason IN ('automod-author', 'distinguished') THEN 'bot' WHEN reason <> '' THEN 'boilerplate' ELSE '-' END AS content_class, CASE WHEN reason = '' THEN '-' ELSE reason END AS reason, count(*) AS n FROM"),
    "registry_published": f"SELECT subreddit AS sub, h AS hash, count(*) AS repeats, 'title' AS kind FROM (SELECT subreddit, {hashed('title', 40)} AS h FROM items) WHERE h IS NOT NULL GROUP BY ALL HAVING count(*) > 1",
    "comment_corpus": f"SELECT reason, selected, n, round(n / (SELECT count(*) FROM talk), 6) AS share FROM ({SELECTS['comment_policy_dry_run']})",
    "analysis_saved": "SELECT q % 5 = 0 AND q % 31 <> 0 AS analyzed, CASE WHEN q % 5 = 0 AND q % 31 <> 0 THEN stance END AS stance, count(*) AS n, CASE WHEN q % 5 = 0 AND q % 31 <> 0 THEN sum(intensity)::BIGINT END AS intensity, count(*) FILTER (q % 5 = 0 AND q % 31 <> 0 AND ai_related) AS ai_related, CASE WHEN q % 5 = 0 AND q % 31 <> 0 THEN sum(topic_chars)::BIGINT END AS topic_chars, CASE WHEN q % 5 = 0 AND q % 31 <> 0 THEN 4 ELSE 3 END AS schema_version FROM (SELECT s.*, length(" + _of(T, "k * 7 + q") + ") + 1 + length(" + _of(T, "u + 3 * q") + ") + CASE WHEN k % 4 = 0 THEN 14 ELSE 0 END AS topic_chars FROM stored s WHERE analyzed OR (q % 31 <> 0 AND q % 5 = 0)) GROUP BY q % 5 = 0 AND q % 31 <> 0, CASE WHEN q % 5 = 0 AND q % 31 <> 0 THEN stance END",
}
_COHORT = f"""SELECT p.frame, p.frame = 'reddit' AS is_primary, ai_posts, neg_posts, {SHARE('neg_posts', 'ai_posts')} AS neg_post_share, coalesce(distinct_authors, 0) AS distinct_authors, {SHARE('coalesce(neg_authors, 0)', 'coalesce(distinct_authors, 0)')} AS neg_author_share,
  distinct_threads, {SHARE('neg_threads', 'distinct_threads')} AS neg_thread_share, {SHARE('intense', 'neg_posts')} AS hi_intensity_neg_share, commented_posts
FROM (SELECT frame, count(*) AS ai_posts, count(*) FILTER (stance IN ('hostile', 'wary')) AS neg_posts, count(DISTINCT id) AS distinct_threads, count(DISTINCT id) FILTER (stance IN ('hostile', 'wary')) AS neg_threads, count(*) FILTER (stance IN ('hostile', 'wary') AND intensity >= 3) AS intense, count(*) FILTER (k % 5 = 0) AS commented_posts FROM framed GROUP BY frame) p
LEFT JOIN (SELECT frame, count(*) AS distinct_authors, count(*) FILTER (stance IN ('hostile', 'wary')) AS neg_authors FROM ({SELECTS['author_modal_stance']}) GROUP BY frame) a ON a.frame = p.frame"""
SELECTS["cohort_by_frame"] = _COHORT
_DAY = "make_timestamp(created_utc * 1000000)::DATE"
#: A day's tickets are 5 a community; what waits goes first, and once more when the stream's time is past its last day.
_ADMITTED = f"""SELECT lane, day, n, last_ticket FROM (
WITH RECURSIVE asks AS (SELECT subreddit AS lane, {_DAY} AS day, count(*) AS n FROM stored GROUP BY ALL),
numbered AS (SELECT *, row_number() OVER (PARTITION BY lane ORDER BY day) AS i FROM asks),
steps AS (SELECT lane, day, i, least(5, n) AS got, n - least(5, n) AS waits FROM numbered WHERE i = 1 UNION ALL
  SELECT m.lane, m.day, m.i, least(5, s.waits + m.n), s.waits + m.n - least(5, s.waits + m.n) FROM steps s JOIN numbered m ON m.lane = s.lane AND m.i = s.i + 1)
SELECT lane, day::VARCHAR AS day, got AS n, got AS last_ticket FROM steps UNION ALL
SELECT lane, (SELECT max(day) FROM asks)::VARCHAR, least(5, waits), least(5, waits) FROM (SELECT *, max(i) OVER (PARTITION BY lane) AS last FROM steps)
WHERE i = last AND waits > 0 AND day < (SELECT max(day) FROM asks))"""
SELECTS |= {
    "stance_by_week_in_halves": SELECTS["stance_by_week"],
    "heatmap_sub_topic_in_halves": SELECTS["heatmap_sub_topic"],
    "recurrence_in_halves": SELECTS["recurrence"],
    "rules_by_sub_in_halves": SELECTS["rules_by_sub"],
    "repeats_in_batches": f"SELECT reason, count(*) AS n FROM (SELECT CASE WHEN author = 'AutoModerator' THEN 'automod-author' WHEN moderator THEN 'distinguished' WHEN stickied THEN 'stickied' WHEN th IS NOT NULL AND count(*) OVER (PARTITION BY subreddit, th) > 1 THEN 'repeat-hash' ELSE '' END AS reason FROM (SELECT *, {hashed('title', 40)} AS th FROM stored)) GROUP BY reason",
    "analysis_merged": SELECTS["analysis_saved"].replace("WHERE analyzed OR (q % 31 <> 0 AND q % 5 = 0)", "WHERE analyzed"),
    "tags_merged": SELECTS["retag_saved"],
    "ingested_rows": f"SELECT subreddit, {_DAY}::VARCHAR AS day, count(*) AS n, 0::BIGINT AS older, max(max(created_utc)) OVER (PARTITION BY subreddit) AS watermark FROM stored GROUP BY subreddit, {_DAY}",
    "admitted_stream": _ADMITTED,
    "vector_cells_top": f"SELECT e.vec_id, round({_COSINE}, 5) AS similarity FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 0) t ORDER BY {_COSINE} DESC, e.vec_id LIMIT 100",
}


def oracle_sql() -> dict[str, str]:
    return {name: CORPUS + select for name, select in SELECTS.items()}
