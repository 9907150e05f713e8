"""The same questions as plain SQL over the same tables, for an independent engine to answer."""

from __future__ import annotations

# The review stand-in. Ids are text; every twentieth buyer only praises, every 37th only pans.
_REVIEWS = """
reviews as (
  select concat(cast(l_orderkey as varchar), '-', cast(l_linenumber as varchar), '-',
                cast(l_partkey as varchar), '-', cast(l_suppkey as varchar)) as review_id,
         cast(o_custkey as varchar) as customer_id,
         cast(l_partkey as varchar) as product_id,
         p_type as product_category,
         cast(case when o_custkey % 20 = 0 then 5 when o_custkey % 37 = 0 then 1
                   else 1 + cast(l_quantity as int) % 5 end as int) as star_rating,
         cast(case when l_suppkey % 10 = 0 then cast(l_quantity as int) % 12 else 0 end as int) as total_votes,
         cast(floor((case when l_suppkey % 10 = 0 then cast(l_quantity as int) % 12 else 0 end)
                    * round(l_discount * 100) / 10) as int) as helpful_votes,
         l_returnflag <> 'R' as verified_purchase,
         cast(o_orderdate as date) as review_date,
         l_orderkey
  from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
)"""

_WINDOWS = """
windowed as (
  select *,
         count(*) over (partition by customer_id order by review_date
                        range between interval 1 day preceding and current row) as rolling_24h_count,
         count(*) over (partition by customer_id) as reviewer_total_reviews,
         avg(star_rating) over (partition by customer_id) as reviewer_avg_rating
  from reviews
)"""

_LABELED = """
flagged as (
  select *,
         coalesce(total_votes >= 5 and helpful_votes / nullif(total_votes, 0) < 0.20, false) as h1_low_helpful,
         rolling_24h_count >= 10 as h2_burst_activity,
         reviewer_total_reviews >= 10
           and (reviewer_avg_rating >= 4.8 or reviewer_avg_rating <= 1.2) as h3_extreme_bias
  from windowed
),
labeled as (
  select *, (h1_low_helpful or h2_burst_activity or h3_extreme_bias) as is_likely_fraud from flagged
)"""


def _bucket(key: str, size: int = 100) -> str:
    return f"(concat('0x', substr(md5(concat('42:', {key})), 1, 8))::bigint % {size})"


def _reviewer_history(rows: str) -> str:
    return f"""
    select g.*, m.rh_max_per_day from (
      select customer_id, count(*) as rh_total_reviews, avg(star_rating) as rh_avg_rating,
             stddev_samp(star_rating) as rh_rating_stddev,
             avg(cast(verified_purchase as int)) as rh_pct_verified,
             cast(date_diff('day', min(review_date), max(review_date)) as int) as rh_days_active
      from {rows} group by customer_id) g
    left join (select customer_id, max(n) as rh_max_per_day
               from (select customer_id, review_date, count(*) as n from {rows} group by all)
               group by customer_id) m on g.customer_id = m.customer_id"""


def _product_history(rows: str) -> str:
    return f"""
    select product_id, count(*) as ph_total_reviews, avg(star_rating) as ph_avg_rating,
           avg(cast(star_rating = 5 as int)) as ph_pct_5star,
           avg(cast(verified_purchase as int)) as ph_pct_verified,
           cast(date_diff('day', min(review_date), max(review_date)) as int) as ph_days_active
    from {rows} group by product_id"""


_RAW = """
raw as (
  select 'US' as marketplace,
         case when o_custkey % 50 <> 7 then cast(o_custkey as varchar) end as customer_id,
         concat(cast(l_orderkey as varchar), '-', cast(l_linenumber as varchar), '-',
                cast(l_partkey as varchar), '-', cast(l_suppkey as varchar)) as review_id,
         case when l_partkey % 100 <> 3 then cast(l_partkey as varchar) end as product_id,
         p_name as product_title,
         p_type as product_category,
         case when cast(l_quantity as int) % 11 = 0 then null else cast(l_quantity as int) % 7 end as star_rating,
         cast(l_quantity as int) % 4 as helpful_votes,
         cast(l_quantity as int) % 12 as total_votes,
         l_returnflag <> 'R' as verified_purchase,
         case when l_suppkey % 9 <> 0 then concat(l_returnflag, ' ', p_brand) else '' end as review_headline,
         case when l_linenumber <> 7 then p_name else '' end as review_body,
         cast(o_orderdate as date) as review_date
  from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
)"""

_DOCS = """
docs as (
  select cast(d.doc_id as varchar) as review_id, d.source as customer_id,
         concat(d.lang, '-', d.source) as product_id, d.lang as product_category,
         cast(n_chars % 5 + 1 as int) as star_rating, cast(n_chars % 3 as int) as helpful_votes,
         cast(n_chars % 7 as int) as total_votes, n_chars % 2 = 0 as verified_purchase,
         d.text as review_body,
         cast(date '1970-01-01' + cast(d.doc_id % 240 + 16405 as int) as date) as review_date,
         l.toxic = 1 as is_likely_fraud
  from documents d left join labels l on d.doc_id = l.doc_id
)"""


def _text(body: str) -> str:
    words = rf"regexp_split_to_array({body}, '\s+')"
    return rf"""
      cast(length({body}) as int) as txt_body_length,
      cast(len({words}) as int) as txt_word_count,
      cast(length(regexp_replace({body}, '[^!]', '', 'g')) as int) as txt_exclamation_count,
      cast(len(list_filter({words}, lambda w: regexp_full_match(w, '[A-Z]{{2,}}'))) as int) as txt_caps_word_count,
      length(regexp_replace({body}, '[^A-Z]', '', 'g')) / greatest(1.0::double, length({body})::double) as txt_caps_ratio"""


_PREDICTIONS = """
predictions as (
  select cast(event_id as varchar) as review_id, cast(user_id as varchar) as product_id,
         event_type as product_category, cast(cast(floor(value) as int) % 5 + 1 as int) as star_rating,
         case when cast(json_extract_string(props, '$.k') as int) % 50 <> 0
              then cast(value / 497 >= 0.1 as int)::double end as prediction,
         value / 497 as fraud_probability, ts as "timestamp"
  from events
)"""

_SCORED = """
scored as (
  select *, case when is_likely_fraud then 1.0::double else 0.0::double end as label,
         case when star_rating in (1, 5) and not verified_purchase then 1.0::double else 0.0::double end as prediction
  from labeled
)"""


def _on_reviews(body: str) -> str:
    return f"with {_REVIEWS} {body}"


def _on_windows(body: str) -> str:
    return f"with {_REVIEWS}, {_WINDOWS} {body}"


def _on_labeled(body: str, more: str = "") -> str:
    return f"with {_REVIEWS}, {_WINDOWS}, {_LABELED}{more} {body}"


def _metrics(keys: str = "") -> str:
    columns, group = (f"{keys}, ", f"group by {keys}") if keys else ("", "")
    return _on_labeled(
        f"""
, cells as (
  select {columns}
         count(*) filter (label = 0 and prediction = 0) as tn, count(*) filter (label = 0 and prediction = 1) as fp,
         count(*) filter (label = 1 and prediction = 0) as fn, count(*) filter (label = 1 and prediction = 1) as tp
  from scored {group}
),
per_class as (
  select *, tn + fp + fn + tp as n,
         coalesce(tn / nullif(tn + fn, 0), 0) as p0, coalesce(tp / nullif(tp + fp, 0), 0) as p1,
         coalesce(tn / nullif(tn + fp, 0), 0) as r0, coalesce(tp / nullif(tp + fn, 0), 0) as r1
  from cells
)
select {columns} tn, fp, fn, tp,
       round((tn + tp) / n, 6) as accuracy,
       round((p0 * (tn + fp) + p1 * (fn + tp)) / n, 6) as weighted_precision,
       round((r0 * (tn + fp) + r1 * (fn + tp)) / n, 6) as weighted_recall,
       round((coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) * (tn + fp)
              + coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) * (fn + tp)) / n, 6) as f1
from per_class""",
        f", {_SCORED}",
    )


_MESSAGE_FIELDS = """
  json_object('review_id', review_id, 'customer_id', customer_id, 'product_id', product_id,
              'product_category', product_category, 'star_rating', star_rating, 'helpful_votes', helpful_votes,
              'total_votes', total_votes, 'verified_purchase', verified_purchase, 'review_body', review_body,
              'review_date', cast(review_date as varchar), 'is_likely_fraud', is_likely_fraud)"""

def _features(history: str) -> str:
    return f"""
measured as (select doc_id, {_text('text')} from documents),
rh as ({_reviewer_history(history)}),
ph as ({_product_history(history)}),
joined as (
  select r.review_id, r.product_category, r.is_likely_fraud, r.star_rating, rh.* exclude (customer_id),
         ph.* exclude (product_id), m.* exclude (doc_id)
  from labeled r
  left join measured m on m.doc_id = r.l_orderkey % (select max(doc_id) + 1 from documents)
  left join rh on rh.customer_id = r.customer_id
  left join ph on ph.product_id = r.product_id
),
features as (
  select review_id, product_category, is_likely_fraud,
         coalesce(rh_total_reviews, 0) as rev_total_reviews,
         round(coalesce(rh_avg_rating, 0), 6) as rev_avg_rating,
         round(coalesce(rh_rating_stddev, 0), 6) as rev_rating_stddev,
         round(coalesce(rh_pct_verified, 0), 6) as rev_pct_verified,
         coalesce(rh_days_active, 0) as rev_days_active,
         coalesce(rh_max_per_day, 0) as rev_max_per_day,
         coalesce(ph_total_reviews, 0) as prod_total_reviews,
         round(coalesce(ph_avg_rating, 0), 6) as prod_avg_rating,
         round(coalesce(ph_pct_5star, 0), 6) as prod_pct_5star,
         round(coalesce(ph_pct_verified, 0), 6) as prod_pct_verified,
         coalesce(ph_days_active, 0) as prod_days_active,
         txt_body_length, txt_word_count, txt_exclamation_count, txt_caps_word_count,
         round(txt_caps_ratio, 6) as txt_caps_ratio,
         round((star_rating - 3) / 2, 6) as txt_sentiment,
         round(star_rating - coalesce(rh_avg_rating, 3.0::double), 6) as xf_rating_vs_reviewer,
         round(star_rating - coalesce(ph_avg_rating, 3.0::double), 6) as xf_rating_vs_product,
         coalesce(cast(star_rating in (1, 5) and ph_avg_rating between 3.5 and 4.5 as int), 0)
           as xf_extreme_review_neutral_product
  from joined
)"""


_FEATURES = _features("labeled")
_FEATURE_NAMES = (
    "rev_total_reviews",
    "rev_avg_rating",
    "rev_rating_stddev",
    "rev_pct_verified",
    "rev_days_active",
    "rev_max_per_day",
    "prod_total_reviews",
    "prod_avg_rating",
    "prod_pct_5star",
    "prod_pct_verified",
    "prod_days_active",
    "txt_body_length",
    "txt_word_count",
    "txt_exclamation_count",
    "txt_caps_word_count",
    "txt_caps_ratio",
    "txt_sentiment",
    "xf_rating_vs_reviewer",
    "xf_rating_vs_product",
    "xf_extreme_review_neutral_product",
)


def _histogram(bins: int, condition: str = "true") -> str:
    return _on_reviews(
        f"""select least(helpful_votes * {bins} // total_votes, {bins - 1})::int as bin,
              round(bin / {bins}, 6) as low, round((bin + 1) / {bins}, 6) as high, count(*) as reviews
            from reviews where total_votes >= 1 and {condition} group by bin"""
    )


_CUT = f"""
encoded as (select {_MESSAGE_FIELDS}::varchar as message, * from docs),
split_up as (select *, length(message) % 11 = 0 as is_cut from encoded)"""

def _ranked(name: str, score: str) -> str:
    """Outcomes and curve of one rule score. A curve has a point for every distinct score, from the highest on; the areas
    are sums of trapezoids, and the precision-recall curve starts level with its first point."""
    return f"""
{name} as (select case when star_rating >= 4 then 1 else 0 end as label, {score} as score from predictions),
{name}_points as (
  select score, sum(label) as hits, count(*) as n from {name} group by score),
{name}_curve as (
  select sum(hits) over w as tp, sum(n - hits) over w as fp, score from {name}_points
  window w as (order by score desc rows unbounded preceding)),
{name}_steps as (
  select tp, fp, coalesce(lag(tp) over o, 0) as tp0, coalesce(lag(fp) over o, 0) as fp0, tp / (tp + fp) as p,
         coalesce(lag(tp / (tp + fp)) over o, tp / (tp + fp)) as p0, max(tp) over () as pos, max(fp) over () as neg
  from {name}_curve window o as (order by score desc)),
{name}_areas as (
  select sum((fp - fp0) * (tp + tp0) / 2.0::double) / (any_value(pos) * any_value(neg))::double as roc_auc,
         sum((tp - tp0) * (p + p0) / 2) / any_value(pos)::double as pr_auc from {name}_steps),
{name}_cells as (
  select count(*)::double as n, count(*) filter (label = 0 and score < 0.3)::double as tn,
         count(*) filter (label = 0 and score >= 0.3)::double as fp, count(*) filter (label = 1 and score < 0.3)::double as fn,
         count(*) filter (label = 1 and score >= 0.3)::double as tp from {name}),
{name}_metrics as (
  select unnest(['accuracy', 'weighted_precision', 'weighted_recall', 'f1', 'roc_auc', 'pr_auc']) as metric,
         unnest([(tn + tp) / n, (tn / (tn + fn) * (tn + fp) + tp / (tp + fp) * (fn + tp)) / n, (tn + tp) / n,
                 (2 * tn / (2 * tn + fp + fn) * (tn + fp) + 2 * tp / (2 * tp + fp + fn) * (fn + tp)) / n,
                 roc_auc, pr_auc]) as {name}
  from {name}_cells, {name}_areas)"""


_BY_VALUE = _ranked("by_value", "fraud_probability")
_BY_NUMBER = _ranked("by_number", "(review_id::bigint * 37 % 997) / 997")

_CLOSED_ALERTS = f"""with {_PREDICTIONS},
        hits as (select *, time_bucket(interval 3 hours, "timestamp") as slot from predictions where prediction = 1),
        placed as (select *, slot as window_start from hits
                   union all select *, slot - interval 3 hours as window_start from hits)
        select cast(p.window_start as varchar) as window_start,
               cast(p.window_start + interval 6 hours as varchar) as window_end, product_category,
               count(*) as fraud_count, round(avg(fraud_probability), 6) as avg_fraud_prob
        from placed p group by p.window_start, product_category
        having count(*) >= 3 and p.window_start + interval 6 hours <= (select max("timestamp") from hits) - interval 10 minutes"""

ORACLE: dict[str, str] = {
    "scan_profile": "\nunion all\n".join(
        f"""select {i}::int as position, '{c}' as column_name, '{t}' as data_type,
                   count(*) as row_count, count(*) - count({c}) as null_count from documents"""
        for i, (c, t) in enumerate(
            (("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"),
             ("n_chars", "bigint"))
        )
    ),
    "scan_sample": "select doc_id, lang, source, substr(text, 1, 60) as headline from documents order by doc_id limit 5",
    "json_encode": f"with {_DOCS} select review_id as key, {_MESSAGE_FIELDS}::varchar as value from docs",
    "json_decode": f"""with {_DOCS}
        select review_id, customer_id, product_id, product_category, star_rating, helpful_votes, total_votes,
               verified_purchase, review_body, cast(review_date as varchar) as review_date,
               coalesce(cast(is_likely_fraud as varchar), '') as is_likely_fraud,
               is_likely_fraud is null as is_likely_fraud_missing
        from docs""",
    "json_dead_letters": f"""with {_DOCS}, {_CUT}
        select substr(message, 1, 40) as malformed, count(*) as messages from split_up where is_cut group by 1""",
    "curate_reviews": f"""with {_RAW} select * replace (cast(review_date as varchar) as review_date) from raw
        where product_category in ('MEDIUM', 'PROMO', 'SMALL') and customer_id is not null
          and product_id is not null and star_rating between 1 and 5""",
    "epoch_day_to_date": f"""with {_RAW}
        select cast(date_diff('day', date '1970-01-01', review_date) as bigint) as review_date,
               cast(review_date as varchar) as as_date, count(*) as reviews from raw r group by r.review_date""",
    "category_counts": _on_reviews("select product_category, count(*) as reviews from reviews group by 1"),
    "rating_counts": _on_reviews("select star_rating, count(*) as reviews from reviews group by 1"),
    "verified_counts": _on_reviews("select verified_purchase, count(*) as reviews from reviews group by 1"),
    "rating_by_category": _on_reviews(
        "select star_rating, "
        + ", ".join(
            f"count(*) filter (product_category = '{c}') as {c.lower()}"
            for c in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
        )
        + " from reviews group by 1"
    ),
    "verified_by_category": _on_reviews(
        """select product_category, count(*) filter (not verified_purchase) as unverified,
                  count(*) filter (verified_purchase) as verified from reviews group by 1"""
    ),
    "helpful_ratio_histogram": _histogram(20),
    "helpful_ratio_histogram_10": _histogram(10),
    "helpful_ratio_sampled": _histogram(20, f"{_bucket('review_id', 1 << 32)} < {round(0.01 * (1 << 32))}"),
    "helpful_extremes": _on_reviews(
        """select count(*) as voted_reviews,
                  round(avg(cast(helpful_votes = 0 as int)), 6) as share_none_helpful,
                  round(avg(cast(helpful_votes = total_votes as int)), 6) as share_all_helpful
           from reviews where total_votes >= 1"""
    ),
    "reviewer_activity": _on_reviews(
        """select n_reviews, count(*) as reviewers
           from (select count(*) as n_reviews from reviews group by customer_id)
           group by n_reviews order by n_reviews limit 50"""
    ),
    "heavy_reviewers": _on_reviews(
        """, per as (select count(*) as n from reviews group by customer_id)
           select l.more_than::int as more_than, count(*) filter (n > more_than) as reviewers,
                  coalesce(sum(n) filter (n > more_than), 0)::bigint as reviews,
                  round(coalesce(sum(n) filter (n > more_than), 0)::double / sum(n), 6) as review_share
           from per, (values (10), (49)) l(more_than) group by 1"""
    ),
    "daily_velocity": _on_reviews("select cast(review_date as varchar) as review_date, count(*) as reviews from reviews group by 1"),
    "weekday_velocity": _on_reviews(
        """select cast((dayofweek(review_date) + 6) % 7 as int) as weekday, count(*) as days,
                  sum(n)::bigint as reviews, round(avg(n), 6) as mean_per_day
           from (select review_date, count(*) as n from reviews group by 1) group by 1"""
    ),
    "velocity_spikes": _on_reviews(
        """, daily as (select review_date, count(*) as reviews from reviews group by 1),
           calendar as (select unnest(generate_series(min(review_date), max(review_date), interval 1 day))::date as review_date from daily),
           filled as (select c.review_date, coalesce(d.reviews, 0) as reviews from calendar c left join daily d using (review_date)),
           compared as (select *, avg(reviews) over (order by review_date rows between 7 preceding and 1 preceding) as base,
                               row_number() over (order by review_date) as age from filled)
           select cast(review_date as varchar) as review_date, reviews, round(base, 6) as baseline,
                  round(reviews / base, 6) as ratio from compared where age > 7 and reviews >= base * 1.35 and base > 0"""
    ),
    "top_reviewers": _on_reviews(
        """, days as (select date_diff('day', min(review_date), max(review_date)) + 1 as n from reviews)
           select row_number() over (order by reviews desc, customer_id)::int as rank, customer_id, reviews,
                  round(reviews / (select n from days), 6) as per_day_of_period
           from (select customer_id, count(*) as reviews from reviews group by 1
                 order by reviews desc, customer_id limit 20)"""
    ),
    "top_reviewer_rate": _on_reviews(
        """select row_number() over (order by reviews desc, customer_id)::int as rank, customer_id, reviews,
                  span_days::int as span_days, round(reviews / span_days, 6) as per_day
           from (select customer_id, count(*) as reviews,
                        date_diff('day', min(review_date), max(review_date)) + 1 as span_days
                 from reviews group by 1 order by reviews desc, customer_id limit 20)"""
    ),
    "verified_share": _on_reviews(
        """select product_category, count(*) as reviews,
                  round(avg(cast(verified_purchase as int)), 6) as verified_share from reviews group by 1"""
    ),
    "rating_share": _on_reviews(
        """select star_rating, count(*) as reviews,
                  round(count(*) / (select count(*) from reviews), 6) as review_share from reviews group by 1"""
    ),
    "extreme_by_verified": _on_reviews(
        """select verified_purchase, count(*) as reviews,
                  round(avg(cast(star_rating in (1, 5) as int)), 6) as extreme_share from reviews group by 1"""
    ),
    "entity_counts": _on_reviews(
        """select count(*) as reviews, count(distinct customer_id) as reviewers,
                  count(distinct product_id) as products from reviews"""
    ),
    "burst_window": _on_windows(
        "select review_id, customer_id, cast(review_date as varchar) as review_date, rolling_24h_count from windowed"
    ),
    "reviewer_window_stats": _on_windows(
        "select review_id, reviewer_total_reviews, round(reviewer_avg_rating, 6) as reviewer_avg_rating from windowed"
    ),
    "burst_window_24h": """
        select event_id, user_id,
               count(*) over (partition by user_id order by ts
                              range between interval 24 hours preceding and current row) as rolling_24h_count
        from events""",
    "h1_low_helpful": _on_labeled(
        """select review_id, helpful_votes, total_votes,
                  round(helpful_votes / nullif(total_votes, 0), 6) as helpful_ratio, h1_low_helpful from labeled"""
    ),
    "h2_burst": _on_labeled("select review_id, h2_burst_activity from labeled"),
    "h3_extreme_bias": _on_labeled("select review_id, h3_extreme_bias from labeled"),
    "label_reviews": _on_labeled(
        """select review_id, customer_id, product_id, product_category, star_rating, total_votes, helpful_votes,
                  verified_purchase, cast(review_date as varchar) as review_date, h1_low_helpful, h2_burst_activity, h3_extreme_bias, is_likely_fraud
           from labeled"""
    ),
    "heuristic_counts": _on_labeled(
        """select count(*) as reviews,
                  count(*) filter (h1_low_helpful) as h1_count, count(*) filter (h2_burst_activity) as h2_count,
                  count(*) filter (h3_extreme_bias) as h3_count, count(*) filter (is_likely_fraud) as any_count,
                  round(h1_count / reviews, 6) as h1_rate, round(h2_count / reviews, 6) as h2_rate,
                  round(h3_count / reviews, 6) as h3_rate, round(any_count / reviews, 6) as any_rate
           from labeled"""
    ),
    "label_rate_gate": _on_labeled(
        """select count(*) as reviews, round(avg(cast(is_likely_fraud as int)), 6) as any_rate,
                  avg(cast(is_likely_fraud as int)) between 0.05 and 0.15 as in_band from labeled"""
    ),
    "threshold_sweep": _on_labeled(
        """select t.burst_reviews::int as burst_reviews, count(*) as reviews,
                  count(*) filter (rolling_24h_count >= burst_reviews) as h2_count,
                  count(*) filter (rolling_24h_count >= burst_reviews or h1_low_helpful or h3_extreme_bias)
                    as any_count,
                  round(h2_count / reviews, 6) as h2_rate, round(any_count / reviews, 6) as any_rate
           from labeled, (values (3), (5), (8), (10)) t(burst_reviews) group by 1"""
    ),
    "entity_split": _on_reviews(
        f"""select customer_id, case when {_bucket('customer_id')} < 70 then 'train' else 'test' end as split
            from (select distinct customer_id from reviews)"""
    ),
    "split_balance": _on_labeled(
        f"""select case when {_bucket('customer_id')} < 70 then 'train' else 'test' end as split,
                   count(*) as reviews, round(count(*) / (select count(*) from reviews), 6) as row_share,
                   count(*) filter (is_likely_fraud) as positives,
                   round(avg(cast(is_likely_fraud as int)), 6) as positive_rate
            from labeled group by 1"""
    ),
    "split_semi_join": _on_reviews(
        """select review_id, customer_id, product_id from reviews
           where customer_id in (select cast(c_custkey as varchar) from customer where c_mktsegment = 'BUILDING')"""
    ),
    "train_test_union": _on_reviews(
        f"""select review_id, customer_id, product_id,
                   case when {_bucket('customer_id')} < 70 then 'train' else 'test' end as split from reviews"""
    ),
    "row_split": _on_reviews(
        f"select review_id, case when {_bucket('review_id')} < 70 then 'train' else 'test' end as split from reviews"
    ),
    "key_sample": _on_reviews(
        f"""select review_id, customer_id, product_id from reviews
            where {_bucket('review_id', 1 << 32)} < {round(0.01 * (1 << 32))}"""
    ),
    "key_sample_small": _on_reviews(
        f"""select review_id, customer_id, product_id from reviews
            where {_bucket('review_id', 1 << 32)} < {round(0.00055 * (1 << 32))}"""
    ),
    "reviewer_lookup": _on_reviews(
        f""", train as (select * from reviews where {_bucket('customer_id')} < 70),
            rh as ({_reviewer_history('train')})
            select customer_id, rh_total_reviews, round(rh_avg_rating, 6) as rh_avg_rating,
                   round(rh_rating_stddev, 6) as rh_rating_stddev, round(rh_pct_verified, 6) as rh_pct_verified,
                   rh_days_active, rh_max_per_day from rh"""
    ),
    "product_lookup": _on_reviews(
        f""", train as (select * from reviews where {_bucket('customer_id')} < 70),
            ph as ({_product_history('train')})
            select product_id, ph_total_reviews, round(ph_avg_rating, 6) as ph_avg_rating,
                   round(ph_pct_5star, 6) as ph_pct_5star, round(ph_pct_verified, 6) as ph_pct_verified,
                   ph_days_active from ph"""
    ),
    "text_features": f"""with {_DOCS}, measured as (select review_id, star_rating, {_text('review_body')} from docs)
        select review_id, txt_body_length, txt_word_count, txt_exclamation_count, txt_caps_word_count,
               round(txt_caps_ratio, 6) as txt_caps_ratio, round((star_rating - 3) / 2, 6) as txt_sentiment
        from measured""",
    "cross_features": _on_labeled(
        "select review_id, xf_rating_vs_reviewer, xf_rating_vs_product, xf_extreme_review_neutral_product from features",
        f", {_FEATURES}",
    ),
    "review_features": _on_labeled("select * from features", f", {_FEATURES}"),
    "train_history_features": _on_labeled(
        "select * from features",
        f", train as (select * from labeled where {_bucket('customer_id')} < 70), {_features('train')}",
    ),
    "enriched_reviews": f"""
        with {_DOCS},
        train as (select * from docs where {_bucket('review_id')} < 70),
        rh as ({_reviewer_history('train')}),
        ph as ({_product_history('train')}),
        measured as (select review_id, {_text('review_body')} from docs)
        select d.review_id, coalesce(rh_total_reviews, 0) as rev_total_reviews,
               round(coalesce(rh_avg_rating, 0), 6) as rev_avg_rating,
               round(coalesce(rh_rating_stddev, 0), 6) as rev_rating_stddev,
               round(coalesce(rh_pct_verified, 0), 6) as rev_pct_verified,
               coalesce(rh_days_active, 0) as rev_days_active, coalesce(rh_max_per_day, 0) as rev_max_per_day,
               coalesce(ph_total_reviews, 0) as prod_total_reviews,
               round(coalesce(ph_avg_rating, 0), 6) as prod_avg_rating,
               round(coalesce(ph_pct_5star, 0), 6) as prod_pct_5star,
               round(coalesce(ph_pct_verified, 0), 6) as prod_pct_verified,
               coalesce(ph_days_active, 0) as prod_days_active,
               m.txt_body_length, m.txt_word_count, m.txt_exclamation_count, m.txt_caps_word_count,
               round(m.txt_caps_ratio, 6) as txt_caps_ratio, round((star_rating - 3) / 2, 6) as txt_sentiment,
               round(star_rating - coalesce(rh_avg_rating, 3.0::double), 6) as xf_rating_vs_reviewer,
               round(star_rating - coalesce(ph_avg_rating, 3.0::double), 6) as xf_rating_vs_product,
               coalesce(cast(star_rating in (1, 5) and ph_avg_rating between 3.5 and 4.5 as int), 0)
                 as xf_extreme_review_neutral_product
        from docs d join measured m on m.review_id = d.review_id
        left join rh on rh.customer_id = d.customer_id left join ph on ph.product_id = d.product_id""",
    "label_distribution": _on_labeled(
        """select case when is_likely_fraud then 1.0::double else 0.0::double end as label, count(*) as reviews
           from labeled group by 1"""
    ),
    "confusion_matrix": _on_labeled(
        """select label, prediction, count(*) as reviews,
                  round(count(*) / (select count(*) from scored), 6) as row_share from scored group by 1, 2""",
        f", {_SCORED}",
    ),
    "confusion_by_category": _on_labeled(
        """select product_category, label, prediction, count(*) as reviews,
                  round(count(*) / sum(count(*)) over (partition by product_category)::double, 6) as row_share
           from scored group by 1, 2, 3""",
        f", {_SCORED}",
    ),
    "weighted_metrics": _metrics(),
    "metrics_by_category": _metrics("product_category"),
    "feature_stddev": _on_labeled(
        "\nunion all\n".join(
            f"select '{c}' as feature, round(stddev_samp({c}), 6) as scale from features" for c in _FEATURE_NAMES
        ),
        f", {_FEATURES}",
    ),
    "score_reviews": _on_labeled(
        f"""select review_id, product_category, is_likely_fraud, true as ranks_well, true as score_is_share, true as verdict_follows
            from labeled where {_bucket('review_id')} >= 70"""
    ),
    "ranking_metrics": f"""with {_PREDICTIONS}, {_BY_VALUE}
        select 'by_value' as model, round(roc_auc, 6) as roc_auc, round(pr_auc, 6) as pr_auc from by_value_areas""",
    "model_comparison": f"""with {_PREDICTIONS}, {_BY_VALUE}, {_BY_NUMBER}
        select metric, round(by_number, 6) as by_number, round(by_value, 6) as by_value
        from by_value_metrics join by_number_metrics using (metric)""",
    "partitioned_roundtrip": _on_reviews(
        """select review_id, customer_id, product_id, product_category, star_rating,
                  cast(review_date as varchar) as review_date from reviews where product_category = 'PROMO'"""
    ),
    "stream_sliding_alerts": _CLOSED_ALERTS,
    "apply_threshold": "select event_id, cast(value / 497 >= 0.05 as int)::double as prediction from events",
    "monitor_totals": f"""with {_PREDICTIONS}
        select count(*) as scored, count(*) filter (prediction = 1) as flagged,
               round(flagged / scored, 6) as flag_rate from predictions""",
    "monitor_recent": f"""with {_PREDICTIONS}
        select strftime("timestamp", '%Y-%m-%d %H:%M:%S.%f') as "timestamp", review_id, product_id, product_category, star_rating,
               round(fraud_probability, 4) as fraud_probability,
               case prediction when 1 then 'Fraud' when 0 then 'Legit' else '' end as prediction,
               prediction is null as prediction_missing
        from predictions order by predictions."timestamp" desc, review_id limit 50""",
    "monitor_product_alerts": f"""with {_PREDICTIONS}
        select product_id, product_category, count(prediction) as fraud_count,
               round(avg(fraud_probability), 4) as avg_fraud_prob
        from predictions where prediction = 1 group by 1, 2 having count(prediction) >= 3""",
    "monitor_category_rate": f"""with {_PREDICTIONS}
        select product_category, count(prediction) as total, count(*) filter (prediction = 1) as fraud,
               round(count(*) filter (prediction = 1) / count(*), 4) as fraud_rate from predictions group by 1""",
    "sliding_alerts": f"""with {_PREDICTIONS},
        hits as (select *, time_bucket(interval 3 hours, "timestamp") as slot from predictions where prediction = 1),
        placed as (select *, slot as window_start from hits
                   union all select *, slot - interval 3 hours as window_start from hits)
        select cast(p.window_start as varchar) as window_start,
               cast(p.window_start + interval 6 hours as varchar) as window_end, product_category,
               count(*) as fraud_count, round(avg(fraud_probability), 6) as avg_fraud_prob
        from placed p group by p.window_start, product_category having count(*) >= 3""",
}

ORACLE["stream_json_decode"] = ORACLE["json_decode"]
ORACLE["history_merge"] = _on_reviews(
    f""", rh as ({_reviewer_history('reviews')})
        select customer_id, rh_total_reviews, round(rh_avg_rating, 6) as rh_avg_rating,
               round(rh_rating_stddev, 6) as rh_rating_stddev, round(rh_pct_verified, 6) as rh_pct_verified,
               rh_days_active, rh_max_per_day from rh""")
ORACLE["product_history_merge"] = _on_reviews(
    f""", ph as ({_product_history('reviews')})
        select product_id, ph_total_reviews, round(ph_avg_rating, 6) as ph_avg_rating,
               round(ph_pct_5star, 6) as ph_pct_5star, round(ph_pct_verified, 6) as ph_pct_verified, ph_days_active from ph""")
ORACLE["entity_sketches"] = _on_reviews(
    """select product_category, count(*) as reviews, count(distinct customer_id) as exact_reviewers,
              count(distinct product_id) as exact_products, true as reviewers_close, true as products_close from reviews group by 1""")
ORACLE["partition_refresh"] = _on_reviews(
    """select review_id, customer_id, product_id, product_category,
              (case when product_category = 'PROMO' then 6 - star_rating else star_rating end)::int as star_rating from reviews""")
ORACLE["scan_files"] = """
    select case when doc_id % 3 = 0 then 'old' else 'new' end as layout, count(*) as row_count,
           count(*) filter (doc_id is null) as doc_id_missing, count(*) filter (doc_id % 3 = 0 or lang is null) as lang_missing,
           count(*) filter (doc_id % 3 = 0 or source is null) as source_missing, count(*) filter (n_chars is null) as n_chars_missing,
           sum(n_chars)::bigint as chars, max(doc_id) as last_id
    from documents group by 1"""
ORACLE["ranking_by_category"] = f"""with {_PREDICTIONS},
    points as (
      select product_category, fraud_probability as score, count(*) filter (star_rating >= 4) as hits, count(*) as n
      from predictions where fraud_probability is not null group by all),
    curve as (
      select *, sum(hits) over w as tp, sum(n - hits) over w as fp from points
      window w as (partition by product_category order by score desc rows unbounded preceding)),
    steps as (
      select *, coalesce(lag(tp) over o, 0) as tp0, coalesce(lag(fp) over o, 0) as fp0, tp / (tp + fp) as p,
             coalesce(lag(tp / (tp + fp)) over o, tp / (tp + fp)) as p0
      from curve window o as (partition by product_category order by score desc))
    select product_category, sum(n)::bigint as reviews, sum(hits)::bigint as positives,
           round(sum((fp - fp0) * (tp + tp0) / 2.0::double) / nullif(sum(hits)::double * sum(n - hits)::double, 0), 6) as roc_auc,
           round(sum((tp - tp0) * (p + p0) / 2) / nullif(sum(hits)::double, 0), 6) as pr_auc
    from steps group by product_category"""

_RULE_SCORED = f"""
    with {_DOCS}, {_CUT},
    train as (select * from docs where {_bucket('review_id')} < 70),
    ph as ({_product_history('train')}),
    valid as (select * from split_up where not is_cut),
    measured as (select review_id, {_text('review_body')} from docs),
    ruled as (
      select d.review_id, d.product_id, d.product_category, d.star_rating,
             round(abs(round(d.star_rating - coalesce(ph_avg_rating, 3.0::double), 6)) / 4 + round(m.txt_caps_ratio, 6), 6) as fraud_probability
      from valid d join measured m on m.review_id = d.review_id left join ph on ph.product_id = d.product_id),
    scored as (select *, cast(fraud_probability >= 0.5 as int)::double as prediction from ruled),
    timed as (select *, timestamp '1970-01-01' + to_minutes(review_id::int) as moment from scored where prediction = 1),
    placed as (select *, time_bucket(interval 1 hour, moment) as window_start from timed
               union all select *, time_bucket(interval 1 hour, moment) - interval 1 hour as window_start from timed)"""
ORACLE["stream_scored"] = f"""{_RULE_SCORED}
    select review_id, product_id, product_category, star_rating, prediction, fraud_probability from scored"""
ORACLE["stream_fan_out_alerts"] = f"""{_RULE_SCORED}
    select cast(window_start as varchar) as window_start, cast(window_start + interval 2 hours as varchar) as window_end,
           product_category, count(*) as fraud_count, round(avg(fraud_probability), 6) as avg_fraud_prob
    from placed p group by p.window_start, product_category having count(*) >= 3"""
ORACLE["stream_batch_counts"] = f"""{_RULE_SCORED}
    select 2::bigint as batches, (select count(*) from docs) as messages, (select count(*) from split_up where is_cut) as broken,
           (select count(*) from scored) as scored, (select count(*) from timed) as flagged"""

_RULE_SCORE = """round(4 * round(v_caps, 6) - floor(v_length / 500) / 10 + abs(v_stars - 3) / 2 / 8
        + case when v_verified then 0.0::double else 0.05::double end, 6)"""
_SWAPPED = {"star_rating": "stars", "txt_caps_ratio": "caps", "txt_body_length": "length", "helpful_votes": "votes",
            "verified_purchase": "verified"}
ORACLE["rule_importance"] = f"""
    with {_DOCS},
    held_out as (
      select review_id, star_rating as stars, helpful_votes as votes, verified_purchase as verified, {_text("coalesce(review_body, '')")},
             case when is_likely_fraud then 1 else 0 end as hit
      from docs where {_bucket('review_id')} >= 70),
    own as (
      select review_id, hit, stars, votes, verified, txt_caps_ratio as caps, txt_body_length as length,
             concat('0x', substr(md5(concat('101:', review_id)), 1, 8))::bigint % 4 as block, md5(concat('102:', review_id)) as place
      from held_out),
    pairs as (
      select *, {", ".join(f"coalesce(lead({n}) over o, first_value({n}) over o) as next_{n}" for n in _SWAPPED.values())}
      from own window o as (partition by block order by place, review_id)),
    variants as (
      select *, unnest(['', {", ".join(f"'{f}'" for f in _SWAPPED)}]) as feature from pairs),
    swapped as (
      select feature, hit, {", ".join(f"case when feature = '{f}' then next_{n} else {n} end as v_{n}" for f, n in _SWAPPED.items())}
      from variants),
    points as (select feature, {_RULE_SCORE} as score, sum(hit) as hits, count(*) as n from swapped group by all),
    curve as (
      select *, sum(hits) over w as tp, sum(n - hits) over w as fp from points
      window w as (partition by feature order by score desc rows unbounded preceding)),
    areas as (
      select feature, sum(n)::bigint as reviews, sum(hits)::bigint as positives,
             sum((n - hits) * (tp + tp - hits) / 2.0::double) / nullif(sum(hits)::double * sum(n - hits)::double, 0) as auc
      from curve group by feature)
    select a.feature, a.reviews, a.positives, round(w.auc, 6) as whole_auc, round(a.auc, 6) as permuted_auc,
           round(w.auc - a.auc, 6) as importance
    from areas a join areas w on w.feature = '' where a.feature <> ''"""

ORACLE["stream_progress"] = f"""with {_PREDICTIONS},
    hits as (select *, review_id::bigint % 2 = 1 as late_part, time_bucket(interval 3 hours, "timestamp") as slot
             from predictions where prediction = 1),
    placed as (select product_category, late_part, slot + interval 6 hours as window_end from hits
               union all select product_category, late_part, slot + interval 3 hours as window_end from hits),
    marks as (select max("timestamp") filter (not late_part) - interval 10 minutes as early,
                     max("timestamp") - interval 10 minutes as last from hits)
    select 'late_alerts' as name,
           (select count(distinct (window_end, product_category)) from placed, marks where late_part and window_end <= early) as late_groups,
           (select count(distinct (window_end, product_category)) from placed, marks where window_end > last) as state_rows,
           strftime(last, '%Y-%m-%dT%H:%M:%S.%gZ') as watermark
    from marks"""
