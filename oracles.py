"""DuckDB twins of the queries, written against the driver tables only."""

WS = r"\t-\r\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
# whole blocks instead of the list of the code under test; the texts hold nothing else of them
BLOCKS = r"\x{2600}-\x{27BF}\x{FE0F}\x{20E3}\x{1F300}-\x{1FAFF}"
EMOJI = rf"[#*0-9]\x{{FE0F}}?\x{{20E3}}|[{BLOCKS}]+"
PUNCTUATION = "!\"$%&''()*+,-./:;<=>?[]^_`{|}~•@#â"
DAY = "%a %b %d %H:%M:%S +0000 %Y"


def unlinked(text):
    links = f"regexp_replace({text}, 'http[^{WS}]+', '', 'g')"
    return f"regexp_replace({links}, 'bit[^\\n]ly/[^{WS}]+', '', 'g')"


def unmarked(text):
    return f"regexp_replace({text}, 'RT[{WS}]@[A-Za-z]+[A-Za-z0-9_-]+', '', 'g')"


def no_emoji(text):
    return f"regexp_replace({text}, '{EMOJI}', '', 'g')"


def cleaned(text):
    return no_emoji(unmarked(f"trim({unlinked(text)}, '[link]')"))


def cleaned_topics(text):
    bare = unmarked(f"trim({unlinked(text)}, '[link]')")
    return no_emoji(f"translate({bare}, '{PUNCTUATION}', '')")


def tokens(text):
    return (
        f"list_filter(regexp_split_to_array(lower({text}), '[^a-zA-Z0-9]+'), "
        "lambda t: length(t) >= 3)"
    )


def video_id(url):
    path = f"regexp_extract({url}, '^(?:[^:/?#]+:)?//[^/?#]*/([^?#]*)', 1)"
    return f"""case
      when regexp_matches({url}, '(?i)^https?://youtu[.]be(:[0-9]+)?(/|$)') then {path}
      when regexp_matches({url}, '(?i)^https?://(www[.])?youtube[.]com(:[0-9]+)?/') then case
        when {path} = 'watch' then nullif(url_decode(regexp_extract({url}, '[?&]v=([^&#]+)', 1)), '')
        when regexp_matches({path}, '^(embed|shorts|v)/') then split_part({path}, '/', 2) end
      end"""


VIEWS = f"""
posts_table as (
  select event_id as tweetid, user_id as userid, concat('u', cast(user_id as varchar)) as screen_name,
         ts as date, event_type as tweet_type, value as followers_count,
         cast(regexp_extract(props, '([0-9]+)', 1) as bigint) as k
  from events),
tweets as (
  select p.*, coalesce(d.lang, 'und') as lang, d.text as text
  from posts_table p left join documents d on d.doc_id = p.tweetid),
topic_weights as (
  select event_id as tweetid, (event_id * 3) % 13 + 1 as w0, (event_id * 5 + 1) % 13 + 1 as w1,
         (event_id * 7 + 2) % 13 + 1 as w2, (event_id * 9 + 3) % 13 + 1 as w3, (event_id * 11 + 4) % 13 + 1 as w4
  from events),
tweet_topics as (
  select tweetid,
    {", ".join(f"case when tweetid % 50 = 0 then cast(0 as double) else cast(w{i} as double) / cast(w0+w1+w2+w3+w4 as double) end as topic_{i}_prob" for i in range(5))}
  from topic_weights),
sentiment_weights as (
  select event_id as tweetid, (event_id * 7) % 19 + 1 as p, (event_id * 5) % 17 + 1 as u, (event_id * 3) % 23 + 1 as n
  from events),
tweet_sentiment as (
  select tweetid,
    {", ".join(f"case when tweetid % 40 = 0 then null else cast({c} as double) / cast(p+u+n as double) end as sa_{name}_score" for c, name in (("p", "positive"), ("u", "neutral"), ("n", "negative")))}
  from sentiment_weights),
posts as (select userid, tweetid from posts_table),
mentions as (select tweetid, k as userid from posts_table where k % 3 = 0),
tags as (select concat('k', cast(k as varchar)) as name, tweetid from posts_table where k % 5 <> 0),
link_urls as (
  select page_id, case page_id % 7
    when 0 then concat('https://www.youtube.com/watch?v=v', cast(page_id % 40 as varchar), '&feature=feedu')
    when 1 then concat('http://youtu.be/v', cast(page_id % 40 as varchar))
    when 2 then concat('https://www.youtube.com/embed/v', cast(page_id % 40 as varchar))
    when 3 then concat('https://www.youtube.com/shorts/v', cast(page_id % 40 as varchar))
    when 4 then concat('http://www.youtube.com/v/v', cast(page_id % 40 as varchar), '?version=3')
    when 5 then 'https://www.youtube.com/channel/abc' else url end as name
  from pages),
tweet_links as (select t.tweetid, l.name from posts_table t join link_urls l on t.tweetid % 1000 = l.page_id),
video_metadata as (
  select distinct concat('v', cast(page_id % 40 as varchar)) as video_id, cast(page_id % 40 as double) * 100 as video_view_count
  from pages where page_id % 40 % 4 <> 0),
users as (
  select c_custkey as userid, concat('u', cast(c_custkey as varchar)) as screen_name,
    case when c_custkey % 7 <> 0 then c_custkey % 2 = 0 end as verified,
    case when c_custkey % 5 <> 0 then c_name end as description,
    case c_custkey % 4 when 0 then 'en' when 1 then 'fr' when 2 then 'und' end as lang,
    case c_mktsegment when 'BUILDING' then 'MYT' when 'MACHINERY' then 'NMYT' when 'HOUSEHOLD' then null
      else c_mktsegment end as cat
  from customer),
any_edges as (select userid, tweetid, 0 as edge from posts union all select userid, tweetid, 1 as edge from mentions),
nodes as (
  select t.tweetid, t.date, t.tweet_type, t.followers_count, t.k * 2 as friends_count,
         t.tweetid + t.k as favourites_count, t.text, p.* exclude (tweetid), s.* exclude (tweetid)
  from tweets t join tweet_topics p on p.tweetid = t.tweetid join tweet_sentiment s on s.tweetid = t.tweetid),
ut_any as (select e.userid, n.* from any_edges e join nodes n on n.tweetid = e.tweetid),
ut_posted as (select e.userid, n.* from posts e join nodes n on n.tweetid = e.tweetid),
video_links as (
  select p.userid, p.tweetid, l.name as video_url, {video_id("l.name")} as video_id
  from posts p join tweet_links l on l.tweetid = p.tweetid
  where contains(l.name, 'http://youtu.be/') or contains(l.name, 'http://www.youtube.com/watch?v')
     or contains(l.name, 'https://www.youtube.com/watch?v') or contains(l.name, 'https://youtu.be/')),
shares as (
  select v.userid, v.tweetid, n.date as tweet_sharing_date, n.text as tweet_text,
         n.sa_positive_score, n.sa_neutral_score, n.sa_negative_score, v.video_url, v.video_id
  from video_links v join nodes n on n.tweetid = v.tweetid),
moderation as (
  select d.userid, count(*) as distinct_videos, count(m.video_id) as found_videos,
         count(*) - count(m.video_id) as moderated_videos
  from (select distinct userid, video_id from shares) d left join video_metadata m on m.video_id = d.video_id
  group by d.userid),
full_metadata as (
  select video_id, concat('title ', video_id) as video_title, concat('channel ', cast(n % 3 as varchar)) as channel_title,
    concat('about ', video_id) as video_description, to_timestamp(1600000000 + n) at time zone 'UTC' as video_publish_date,
    cast(n % 30 as double) as video_category, cast(n as double) as video_view_count,
    case when n % 300 = 0 then null else cast(n + 1 as double) end as video_comment_count,
    cast(n * 2 as double) as video_like_count, cast(n % 11 as double) as video_dislike_count,
    concat('tag', cast(n % 5 as varchar)) as tag_0, video_id as tag_1
  from (select video_id, cast(video_view_count as bigint) as n from video_metadata)),
decorated as (
  select doc_id as tweetid, source, lang,
    concat('RT @', source, '_', cast(doc_id as varchar), ': ', text, ' https://t.co/', cast(doc_id as varchar),
      ' "u" ', chr(128512), ' bit.ly/', cast(doc_id as varchar), ' [link]') as text
  from documents),
raw as (
  select tweetid, userid, screen_name, date,
    case tweet_type when 'click' then 'reply' when 'purchase' then 'quoted_tweet'
      when 'signup' then 'retweeted_tweet_without_comment' else 'original' end as tweet_type,
    text, concat('retweeted ', coalesce(text, '')) as rt_text, lang, k,
    case when k % 5 = 0 then cast([] as varchar[]) when k % 5 = 1 then [concat('K', k)] else [concat('K', k), 'it''s'] end as hashtag,
    case when k % 3 <> 0 then 0 when k % 2 = 0 then 2 else 1 end as n_mentions,
    case k % 4 when 0 then concat('https://youtu.be/v', k % 40) when 1 then concat('https://example.org/', k) end as url,
    case when k % 10 = 0 then tweetid + 1 end as reply_statusid,
    k * 2 as friends_count, k % 7 as listed_count, tweetid % 1000 as followers_count, tweetid + k as favourites_count,
    tweetid as statuses_count, userid % 2 = 0 as verified, concat('bio ', k) as description,
    concat('https://example.org/p/', k) as profile_pic_url, concat('https://example.org/b/', k) as profile_banner_url,
    strftime(date, '{DAY}') as day
  from tweets),
raw_mentions as (
  select tweetid, date, 0 as pos, k as userid, concat('u', k) as screen_name from raw where n_mentions >= 1
  union all
  select tweetid, date, 1 as pos, k + 1000 as userid, concat('v', k) as screen_name from raw where n_mentions = 2),
raw_counts as (
  select userid, count(*) as tweets_count, sum(len(hashtag)) as hashtags_count,
         sum(greatest(len(hashtag), 1)) as literal_hashtags, count(case when k % 4 = 0 then 1 end) as yt_shares_count
  from raw group by userid),
topic_texts as (
  select userid, list_position(probs, list_max(probs)) - 1 as topic, date, tweetid, edge, text
  from (select e.userid, e.edge, n.date, n.tweetid, n.text,
               [topic_0_prob, topic_1_prob, topic_2_prob, topic_3_prob, topic_4_prob] as probs
        from any_edges e join nodes n on n.tweetid = e.tweetid where n.text is not null)),
corpora as (
  select userid, topic, {cleaned("string_agg(text, chr(10) order by date, tweetid, edge)")} as corpus,
         sum(length(text)) + count(*) - 1 as raw_chars
  from topic_texts group by userid, topic),
corpus_lines as (
  select userid, topic, unnest(string_split(corpus, chr(10))) as line,
         generate_subscripts(string_split(corpus, chr(10)), 1) as rn
  from corpora),
sized_lines as (select *, length(line) + 1 as size from corpus_lines),
video_corpora as (
  select userid, {cleaned("string_agg(tweet_text, chr(10) order by tweet_sharing_date, tweetid, video_url)")} as corpus
  from shares s where tweet_text is not null and not exists (select 1 from video_metadata m where m.video_id = s.video_id)
  group by userid),
packed as (
  select userid, topic, rn, line, case when size > 1000 then 1 else 0 end as batch_no, size as fill
  from sized_lines where rn = 1
  union all
  select l.userid, l.topic, l.rn, l.line,
         case when p.fill + l.size <= 1000 then p.batch_no else p.batch_no + 1 end,
         case when p.fill + l.size <= 1000 then p.fill + l.size else l.size end
  from packed p join sized_lines l on l.userid = p.userid and l.topic = p.topic and l.rn = p.rn + 1),
batches as (
  select userid, topic, batch_no, concat(string_agg(line, chr(10) order by rn), chr(10)) as batch
  from packed group by userid, topic, batch_no),
all_batches as (
  select * from batches
  union all
  select userid, topic, 0, '' from batches group by userid, topic having min(batch_no) > 0),
drawn as (
  select userid, topic, batch,
         row_number() over (partition by userid, topic order by md5(concat_ws('|', '42', userid, topic, batch_no))) as pick
  from all_batches),
sampled as (
  select userid, topic, string_agg(batch, chr(10) order by pick) as text from drawn where pick <= 12 group by userid, topic),
gated as (
  select c.userid, c.topic, length(c.corpus) as n_chars, length(c.corpus) > 12000 as sampled,
         case when length(c.corpus) > 12000 then s.text else c.corpus end as text
  from corpora c join sampled s on s.userid = c.userid and s.topic = c.topic),
summary_words as (
  select userid, topic, sum(n_words) as n_available from (
    select userid, topic, len(list_filter(regexp_split_to_array(line, '[ \\t]+'), lambda w: w <> '')) as n_words
    from (select userid, topic, unnest(string_split(text, chr(10))) as line from gated)
    where len({tokens("line")}) > 0)
  group by userid, topic),
video_words as (
  select userid, sum(n_words) as n_available from (
    select userid, len(list_filter(regexp_split_to_array(line, '[ \\t]+'), lambda w: w <> '')) as n_words
    from (select userid, unnest(string_split(corpus, chr(10))) as line from video_corpora)
    where len({tokens("line")}) > 0)
  group by userid),
doc_tokens as (select tweetid, {tokens(cleaned_topics("text"))} as tokens from decorated),
stopwords as (
  select term as word from (select unnest(tokens) as term from doc_tokens) group by term order by count(*) desc, term limit 40),
kept_tokens as (
  select tweetid, list_filter(tokens, lambda t: not list_contains(words, t)) as tokens
  from doc_tokens cross join (select list(word) as words from stopwords))
"""

TOPIC_COLUMNS = [f"topic_{i}_prob" for i in range(5)]
SCORES = ["sa_positive_score", "sa_neutral_score", "sa_negative_score"]


def wins(k, literal=False):
    terms = []
    for other in range(5):
        if other != k:
            left = 2 if literal and k == 3 and other == 0 else k
            terms.append(f"topic_{left}_prob > topic_{other}_prob")
    return " and ".join(terms)


def strict(literal=False):
    return "case " + " ".join(f"when {wins(k, literal)} then {k}" for k in range(5)) + " end"


def half_up(x, digits):
    return f"round({x}, {digits})"


def half_even(x, digits):
    return f"round_even({x} * {10**digits}, 0) / {10**digits}"


def node_columns(row):
    return ", ".join(f"{row}.{c}" for c in TOPIC_COLUMNS)


RAW_TWEET_PROPERTIES = (
    "date, tweet_type, friends_count, listed_count, followers_count, favourites_count, statuses_count"
)
RAW_USER_PROPERTIES = (
    "screen_name, description, lang, friends_count, listed_count, followers_count, favourites_count, "
    "statuses_count, verified, profile_pic_url, profile_banner_url, screen_name as display_name, "
    "day as date_first_tweet, day as account_creation_date, cat"
)
PROFILE = ("followers_count", "friends_count", "favourites_count")
DELTAS = ", ".join(
    f"arg_min({c}, (date, tweetid)) as first_{c}, arg_max({c}, (date, tweetid)) as last_{c}, "
    f"arg_max({c}, (date, tweetid)) - arg_min({c}, (date, tweetid)) as delta_{c}"
    for c in PROFILE
)
TYPES = ("view", "click", "purchase", "signup")
TYPE_COUNTS = ", ".join(f"count(case when tweet_type = '{t}' then 1 end) as n_{t}" for t in TYPES)
COHORT_RANK = """(select userid, tweets_count, hashtags_count, yt_shares_count from raw_counts
    where tweets_count between 60 and 75 and hashtags_count > 0 and yt_shares_count > 0
    order by tweets_count desc, yt_shares_count desc, hashtags_count desc, userid limit 50)"""
SENTIMENT_SERIES = f"(select *, {strict()} as topic from ut_posted where {strict()} is not null)"
MEASURES = ", ".join(
    f"{half_even(f'(coalesce(sum({c}), 0) / count(*) * 100)', 2)} as {c.split('_')[1]}_percent"
    for c in SCORES
)
MEANS = ", ".join(
    f"{half_even(f'(coalesce(sum({c}), 0) / count(*))', 2)} as {c.split('_')[1]}_mean" for c in SCORES
)
SUFFIXES = "('com'), ('net'), ('org'), ('io'), ('example.com'), ('co.uk')"

SELECTS = {
    # sources
    "parquet_scan": "select tweetid, userid, date, tweet_type from posts_table",
    # cohort
    "rank_users": f"select * from {COHORT_RANK}",
    "rank_users_literal_hashtags": """select userid, tweets_count, literal_hashtags as hashtags_count, yt_shares_count
        from raw_counts where tweets_count between 60 and 75 and yt_shares_count > 0
        order by tweets_count desc, yt_shares_count desc, literal_hashtags desc, userid limit 50""",
    "tweets_per_user": "select userid, tweets_count from raw_counts",
    "tweets_per_user_between": "select userid, tweets_count from raw_counts where tweets_count between 60 and 75",
    "hashtags_per_user": "select userid, hashtags_count from raw_counts where hashtags_count > 0",
    "hashtags_per_user_literal": "select userid, literal_hashtags as hashtags_count from raw_counts",
    "video_shares_per_user": "select userid, yt_shares_count from raw_counts where yt_shares_count > 0",
    "parsed_lists": """select tweetid, array_to_string(hashtag, '|') as hashtag, len(hashtag) as n_hashtags,
        n_mentions as n_mention_ids, coalesce(url, '') as urls, k % 4 = 0 as shares_video from raw""",
    "restrict_to_cohort": f"""select r.tweetid, r.userid, c.tweets_count, c.yt_shares_count, c.hashtags_count
        from raw r join {COHORT_RANK} c on c.userid = r.userid""",
    "enrich_profiles": """select r.tweetid, r.screen_name, c.c_mktsegment as cat
        from raw r left join customer c on concat('u', c.c_custkey) = r.screen_name""",
    "with_topics": f"""select r.tweetid, r.userid, {node_columns("p")} from raw r join tweet_topics p on p.tweetid = r.tweetid""",
    "build_cohort": f"""select r.tweetid, r.userid, r.screen_name, r.reply_statusid, r.day as date_first_tweet,
        r.day as account_creation_date, u.c_mktsegment as cat, c.tweets_count, c.yt_shares_count, c.hashtags_count,
        {node_columns("p")}
        from raw r join {COHORT_RANK} c on c.userid = r.userid
        left join customer u on concat('u', u.c_custkey) = r.screen_name
        join tweet_topics p on p.tweetid = r.tweetid""",
    # graph construction
    "graph_tweets": f"""select r.tweetid, {RAW_TWEET_PROPERTIES},
        case when tweet_type = 'retweeted_tweet_without_comment' then rt_text else text end as text, {node_columns("p")}
        from raw r join tweet_topics p on p.tweetid = r.tweetid""",
    "graph_authors": f"""select userid, {RAW_USER_PROPERTIES} from (
        select r.*, c.c_mktsegment as cat, row_number() over (partition by r.userid order by date desc, tweetid desc) as rn
        from raw r left join customer c on concat('u', c.c_custkey) = r.screen_name) where rn = 1""",
    "graph_stub_users": """select userid, arg_min(screen_name, (date, tweetid, pos)) as screen_name from raw_mentions
        where userid not in (select userid from raw) group by userid""",
    "graph_users": f"""select userid, {RAW_USER_PROPERTIES} from (
        select r.*, c.c_mktsegment as cat, row_number() over (partition by r.userid order by date desc, tweetid desc) as rn
        from raw r left join customer c on concat('u', c.c_custkey) = r.screen_name) where rn = 1
        union all by name
        select userid, arg_min(screen_name, (date, tweetid, pos)) as screen_name from raw_mentions
        where userid not in (select userid from raw) group by userid""",
    "graph_posts": "select distinct userid, tweetid from raw",
    "graph_tags": "select distinct lower(name) as name, tweetid from (select unnest(hashtag) as name, tweetid from raw)",
    "graph_hashtags": "select distinct lower(name) as name from (select unnest(hashtag) as name from raw)",
    "graph_mentions": "select distinct tweetid, userid from raw_mentions",
    "graph_tweet_links": "select tweetid, url as name from raw where url is not null",
    "graph_links": "select distinct url as name from raw where url is not null",
    "mention_pairs": "select tweetid, userid, screen_name from raw_mentions",
    "effective_text": """select tweetid, md5(case when tweet_type = 'retweeted_tweet_without_comment' then rt_text else text end) as text_md5
        from raw""",
    "posted_text": """select p.tweetid, md5(n.text) as text_md5, u.lang
        from posts p join nodes n on n.tweetid = p.tweetid join users u on u.userid = p.userid""",
    # joins over the graph
    "user_tweets_posted": "select userid, tweetid, date, tweet_type from ut_posted",
    "user_tweets_any": "select userid, tweetid, date, tweet_type from ut_any",
    "user_hashtags": "select e.userid, e.tweetid, t.name as hashtag from any_edges e join tags t on t.tweetid = e.tweetid",
    "user_links": "select userid, tweetid, video_url from video_links",
    "attach_sentiment": "select tweetid, tweet_type, sa_positive_score, sa_neutral_score, sa_negative_score from nodes",
    # counts and series
    "tweet_type_counts": "select userid, tweet_type, count(*) as n_tweets from ut_any group by all",
    "tweet_type_counts_wide": f"select userid, {TYPE_COUNTS} from ut_any group by userid",
    "hashtag_counts": "select userid, name as hashtag, count(*) as count_hashtag from any_edges join tags using (tweetid) group by all",
    "top_hashtags": """select * from (select userid, hashtag, count_hashtag,
        row_number() over (partition by userid order by count_hashtag desc, hashtag) as rank
        from (select userid, name as hashtag, count(*) as count_hashtag from any_edges join tags using (tweetid) group by all))
        where rank <= 20""",
    "counter_delta": f"select userid, {DELTAS} from ut_any group by userid",
    "date_bounds": "select userid, min(date) as min_date, max(date) as max_date from ut_any group by userid",
    "profile_report": f"select userid, {DELTAS}, min(date) as min_date, max(date) as max_date from ut_any group by userid",
    "profile_series": """select userid, date, tweetid, followers_count, friends_count, favourites_count from ut_any
        where date between timestamp '2024-01-01 00:00:00' and timestamp '2024-01-20 00:00:00'""",
    "default_range_first": """select s.userid, s.tweetid, s.video_id from shares s
        join (select userid, min(tweet_sharing_date) as first from shares group by userid) b
          on b.userid = s.userid and s.tweet_sharing_date = b.first""",
    "default_range_full": "select userid, tweetid from ut_any",
    "overview_report": f"""select u.userid, u.screen_name, b.description, {", ".join(f"coalesce(c.n_{t}, 0) as n_{t}" for t in ("original", "reply", "quoted_tweet", "retweeted_tweet_without_comment"))}
        from users u left join (select screen_name, min(description) as description from users group by all) b on b.screen_name = u.screen_name
        left join (select userid, {", ".join(f"count(case when tweet_type = '{e}' then 1 end) as n_{t}" for e, t in (("view", "original"), ("click", "reply"), ("purchase", "quoted_tweet"), ("signup", "retweeted_tweet_without_comment")))}
          from ut_any group by userid) c on c.userid = u.userid
        where u.verified is not null""",
    "monitored_users": "select userid, screen_name from users where verified is not null",
    "user_bio": "select screen_name, min(description) as description from users group by screen_name",
    "user_category": """select userid, cat, case cat when 'MYT' then 'shared moderated videos'
        when 'NMYT' then 'never shared a moderated video' else 'error: category unknown' end as category_label
        from users where cat is not null""",
    "one_user": "select userid, screen_name, tweetid, date from posts_table where screen_name = 'u7'",
    "one_user_clustered": """select userid, tweetid, date, followers_count, friends_count, favourites_count
        from ut_any where userid in (select userid from users where screen_name = 'u7')""",
    "collect_names": "select distinct screen_name from users",
    "row_count": "select count(*) as n from posts_table",
    # topics
    "topic_means": f"select userid, {', '.join(f'{half_up(f'avg({c})', 4)} as {c}' for c in TOPIC_COLUMNS)} from ut_any group by userid",
    "topic_shares": f"""select userid, {", ".join(f"round(m{i} / nullif(m0+m1+m2+m3+m4, 0) * 100, 6) as topic_{i}_share" for i in range(5))}
        from (select userid, {", ".join(f"{half_up(f'avg({c})', 4)} as m{i}" for i, c in enumerate(TOPIC_COLUMNS))} from ut_any group by userid)""",
    "topic_series": f"select userid, date, tweetid, {', '.join(f'{half_up(c, 4)} as {c}' for c in TOPIC_COLUMNS)} from ut_any",
    "strict_topic": f"select tweetid, {strict()} as topic from tweet_topics",
    "strict_topic_literal": f"select tweetid, {strict(True)} as topic from tweet_topics",
    "argmax_topic": f"""select tweetid, list_position(p, list_max(p)) - 1 as topic,
        ['Presidenza di Trump', 'Campagna presidenziale', 'Confronto elettorale', 'Impatto delle elezioni', 'Caso Georgia'][list_position(p, list_max(p))] as topic_label
        from (select tweetid, [{", ".join(TOPIC_COLUMNS)}] as p from tweet_topics)""",
    "vector_columns": f"select tweetid, {', '.join(TOPIC_COLUMNS)} from tweet_topics",
    # sentiment
    "sentiment_series": f"select userid, topic, date, tweetid, {', '.join(SCORES)} from {SENTIMENT_SERIES}",
    "sentiment_series_literal": f"""select userid, topic, date, tweetid, {', '.join(SCORES)}
        from (select *, {strict(True)} as topic from ut_posted) where topic is not null""",
    "sentiment_percent": f"select userid, topic, {MEASURES} from {SENTIMENT_SERIES} group by userid, topic",
    "sentiment_mean": f"select userid, topic, {MEANS} from {SENTIMENT_SERIES} group by userid, topic",
    "rank_labels": """select tweetid,
        list_reverse_sort([{'score': sa_positive_score, 'label': 'positive'}, {'score': sa_neutral_score, 'label': 'neutral'},
          {'score': sa_negative_score, 'label': 'negative'}])[1].label as best,
        list_reverse_sort([{'score': sa_positive_score, 'label': 'positive'}, {'score': sa_neutral_score, 'label': 'neutral'},
          {'score': sa_negative_score, 'label': 'negative'}])[3].label as worst
        from tweet_sentiment where sa_positive_score is not null""",
    "softmax": """select tweetid, round(exp(p) / (exp(p) + exp(u) + exp(n)), 9) as p0,
        round(exp(u) / (exp(p) + exp(u) + exp(n)), 9) as p1, round(exp(n) / (exp(p) + exp(u) + exp(n)), 9) as p2
        from sentiment_weights""",
    "needs_translation": """select tweetid, md5(text) as text_md5,
        coalesce(lang is distinct from 'en' and lang is distinct from 'und' and text <> '', false) as routed from decorated""",
    "apply_translations": """select tweetid, lang, md5(case when lang is distinct from 'en' and lang is distinct from 'und' and text <> ''
        and tweetid % 3 <> 0 then concat('translated ', cast(tweetid as varchar)) else text end) as text_md5 from decorated""",
    # text
    "cleaning_steps": f"""select tweetid, md5({unlinked("text")}) as unlinked, md5(trim(text, '[link]')) as stripped,
        md5({unmarked("text")}) as unmarked, md5(translate(text, '{PUNCTUATION}', '')) as unpunctuated,
        md5({no_emoji("text")}) as no_emoji, md5(regexp_replace(text, '"["u\\n#*0-9{BLOCKS}]+"', '', 'g')) as no_literal_emoji
        from decorated""",
    "clean_text_topics": f"select tweetid, {cleaned_topics('text')} as text from decorated",
    "clean_text_corpus": f"select tweetid, {cleaned('text')} as text from decorated",
    "text_lines": """select doc_id, len(string_split(text, chr(10))) as n_lines, length(text) as n_chars,
        list_max(list_transform(string_split(text, chr(10)), lambda x: length(x))) as longest from documents""",
    "token_counts": "select tweetid, len(tokens) as n_tokens, md5(array_to_string(tokens, ' ')) as tokens_md5 from doc_tokens",
    "stopwords_dropped": "select tweetid, len(tokens) as n_tokens, md5(array_to_string(tokens, ' ')) as tokens_md5 from kept_tokens",
    "term_counts": """select o.term, o.n_occurrences, d.n_documents
        from (select term, count(*) as n_occurrences from (select unnest(tokens) as term from kept_tokens) group by term) o
        join (select term, count(*) as n_documents from (select unnest(list_distinct(tokens)) as term from kept_tokens) group by term) d
          on d.term = o.term""",
    # values
    "dates": f"""select tweetid, date_trunc('second', date) as parsed, day as formatted, date as lenient,
        to_timestamp(tweetid + 1600000000) at time zone 'UTC' as from_epoch, reply_statusid, cast(k as double) as count_value,
        concat('id', tweetid) as id_text from raw""",
    # videos
    "video_ids": f"select page_id, name, {video_id('name')} as video_id from link_urls",
    "video_url_rules": """select page_id, regexp_matches(name, '^https?://(www[.]youtube[.]com|youtu[.]be)/') as by_prefix,
        contains(name, 'http://youtu.be/') or contains(name, 'http://www.youtube.com/watch?v')
          or contains(name, 'https://www.youtube.com/watch?v') or contains(name, 'https://youtu.be/') as by_substring
        from link_urls""",
    "registered_domain": f"""select page_id, url, concat(coalesce(labels[len(labels) - depth], ''), '.', suffix) as domain from (
        select page_id, url, labels, coalesce(max(len(string_split(s.suffix, '.'))), 0) as depth,
               coalesce(arg_max(s.suffix, len(string_split(s.suffix, '.'))), '') as suffix
        from (select page_id, url, string_split(lower(regexp_extract(url, '^[^:/?#]+://([^/?#:]+)', 1)), '.') as labels from pages) p
        left join (values {SUFFIXES}) s(suffix)
          on array_to_string(p.labels, '.') = s.suffix or ends_with(array_to_string(p.labels, '.'), concat('.', s.suffix))
        group by page_id, url, labels)""",
    "registered_domain_rules": """select page_id, case page_id % 8
          when 0 then concat('https://x', page_id, '.Foo.ck/p?q=1') when 1 then 'https://www.ck/p?q=1'
          when 2 then concat('https://sub', page_id, '.www.ck/p?q=1') when 3 then 'https://foo.ck:8080/p?q=1'
          when 4 then concat('https://host', page_id, '.unknown/p?q=1') when 5 then concat('https://10.0.0.', page_id % 250, '/p?q=1')
          when 6 then concat('https://user@a.b', page_id, '.kobe.jp/p?q=1') else concat('https://c', page_id, '.city.kobe.jp/p?q=1') end as url,
        case page_id % 8
          when 0 then concat('x', page_id, '.foo.ck') when 1 then 'www.ck' when 2 then 'www.ck' when 3 then '.foo.ck'
          when 4 then 'unknown.' when 5 then concat('10.0.0.', page_id % 250, '.')
          when 6 then concat('a.b', page_id, '.kobe.jp') else 'city.kobe.jp' end as domain
        from pages""",
    "flattened_lists": """select doc_id, len(words)::int as n_words, md5(array_to_string(words, '|')) as words_md5
        from (select doc_id, string_split(replace(text, chr(10), ' '), ' ') as words from documents)""",
    "video_tweets": f"""select userid, tweetid, tweet_sharing_date, md5(tweet_text) as text_md5, video_url, video_id, {', '.join(SCORES)} from shares""",
    "distinct_videos": "select userid, count(*) as distinct_videos from (select distinct userid, video_id from shares) group by userid",
    "video_moderation": "select * from moderation",
    "moderated_count": "select userid, moderated_videos from moderation",
    "video_shares": "select s.userid, s.tweetid, s.video_id, m.video_view_count from shares s join video_metadata m on m.video_id = s.video_id",
    "moderated_shares": """select userid, tweetid, video_url, video_id from shares s
        where not exists (select 1 from video_metadata m where m.video_id = s.video_id)""",
    "users_without_videos": """select userid, screen_name from users
        where verified is not null and userid not in (select userid from video_links)""",
    "typed_video_metadata": "select * from full_metadata",
    "video_cards": f"""select s.userid, s.tweetid, s.video_id, m.video_title, m.channel_title,
        cast(m.video_view_count as bigint) as video_view_count, cast(m.video_comment_count as bigint) as video_comment_count,
        cast(m.video_like_count as bigint) as video_like_count, m.video_description, s.tweet_sharing_date, {", ".join(f"s.{c}" for c in SCORES)}
        from shares s join full_metadata m on m.video_id = s.video_id
        where s.tweet_sharing_date between timestamp '2024-01-01 00:00:00' and timestamp '2024-01-20 00:00:00'""",
    "video_report_cards": f"""select s.userid, s.tweetid, s.video_id, m.video_title, m.channel_title,
        cast(m.video_view_count as bigint) as video_view_count, cast(m.video_comment_count as bigint) as video_comment_count,
        cast(m.video_like_count as bigint) as video_like_count, m.video_description, s.tweet_sharing_date, {", ".join(f"s.{c}" for c in SCORES)}
        from shares s join full_metadata m on m.video_id = s.video_id
        join (select s.userid, min(s.tweet_sharing_date) as first from shares s join video_metadata m on m.video_id = s.video_id group by s.userid) b
          on b.userid = s.userid and b.first = s.tweet_sharing_date""",
    # corpora
    "corpus_sizes": "select userid, topic, count(*) as n_texts, sum(length(text)) + count(*) - 1 as raw_chars from topic_texts group by all",
    "corpus_lengths": "select userid, topic, len(string_split(corpus, chr(10))) as n_lines, length(corpus) as n_chars from corpora",
    "topic_corpus": "select userid, topic, line from corpus_lines",
    "packed_batches": "select userid, topic, batch_no, batch from all_batches",
    "sampled_batches": "select userid, topic, pick, batch from drawn where pick <= 12",
    "gate": "select userid, topic, n_chars, sampled, text from gated",
    # the rule of the summary is not repeated: its length must fit what the text has, and its lines be lines of it
    "topic_summaries": """select g.userid, g.topic, g.sampled, coalesce(w.n_available, 0)::bigint as n_available,
        true as within, true as of_text
        from gated g left join summary_words w on w.userid = g.userid and w.topic = g.topic""",
    "moderated_summaries": """select c.userid, length(c.corpus) > 12000 as sampled,
        case when length(c.corpus) <= 12000 then coalesce(w.n_available, 0)::bigint end as n_available,
        true as within, true as of_text
        from video_corpora c left join video_words w on w.userid = c.userid""",
    "moderated_corpus": "select userid, unnest(string_split(corpus, chr(10))) as line from video_corpora",
}


# what must hold of the fitted models, whatever the fit
SELECTS["topic_scores"] = """select tweetid, len(tokens) > 0 as has_terms, true as in_range, true as sums from kept_tokens"""
SELECTS["topic_terms"] = """select t::int as topic, r::int as rank, true as falls, true as is_term
    from range(5) a(t), range(1, 16) b(r)"""
SELECTS["score_sentiment"] = "select tweetid, true as in_range, true as sums from decorated"
SELECTS["sentiment_job"] = """select n.tweetid, p.tweetid is not null as scored,
    case when p.tweetid is not null then true end as in_range, case when p.tweetid is not null then true end as sums
    from nodes n left join (select distinct p.tweetid from posts p join users u on u.userid = p.userid) p on p.tweetid = n.tweetid"""
SELECTS["topic_coherence"] = """, kept as (select tweetid, unnest(list_distinct(tokens)) as term from kept_tokens),
    top as (
      select term, row_number() over (order by n desc, term) - 1 as place
      from (select term, count(*) as n from (select unnest(tokens) as term from kept_tokens) group by term)
      qualify place < 75),
    held as (select k.tweetid, place % 5 as topic, place // 5 as rank from kept k join top t on t.term = k.term),
    single as (select topic, rank, count(*) as n from held group by all),
    paired as (
      select a.topic, a.rank as first, b.rank as second, count(*) as n
      from held a join held b on b.tweetid = a.tweetid and b.topic = a.topic and b.rank > a.rank group by all),
    pairs as (
      select a.topic, ln((coalesce(x.n, 0) + 1) / s.n) as value
      from (select place % 5 as topic, place // 5 as rank from top) a
      join (select place % 5 as topic, place // 5 as rank from top) b on b.topic = a.topic and b.rank > a.rank
      join single s on s.topic = a.topic and s.rank = a.rank
      left join paired x on x.topic = a.topic and x.first = a.rank and x.second = b.rank)
    select topic::int as topic, 15 as n_terms, round(avg(value), 6) as coherence from pairs group by topic"""
SELECTS["sentiment_accuracy"] = """select 3 as folds, count(*) as n, true as in_range
    from labels join documents using (doc_id)"""

# a graph merged from batches is the graph built at once
for name in ("tweets", "users", "mentions"):
    SELECTS[f"merged_graph_{name}"] = SELECTS[f"graph_{name}"]


def sql() -> dict[str, str]:
    return {name: f"with recursive {VIEWS.rstrip()}{select}" if select.startswith(",") else f"with recursive {VIEWS} {select}" for name, select in SELECTS.items()}
