"""DuckDB SQL giving the same result as each registered query.

`PRELUDE` states the mapped views of `workload.mapping` and the marts over them; each entry of
`ORACLE` is a final SELECT over those.
"""

from __future__ import annotations

_VIEWS = """
by_nation as (
  select o.*, c.c_name, n.n_nationkey, n.n_name
  from orders o join customer c on c.c_custkey = o.o_custkey
  join nation n on n.n_nationkey = c.c_nationkey
),
pulls as (
  select b.n_name as repository, b.o_orderkey as pr_number, b.c_name as author_login,
    b.o_orderdate as created_at,
    case when b.o_orderstatus = 'F' then
      (select min(l.l_shipdate) from lineitem l
       where l.l_orderkey = b.o_orderkey and l.l_shipdate >= b.o_orderdate) end as merged_at
  from by_nation b
),
commits as (
  select concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) as commit_sha,
    n_name as repository,
    case when l_returnflag = 'N' and l_linestatus = 'O' then null else c_name end as author_login,
    l_shipdate as committed_at
  from lineitem join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey
  join supplier on s_suppkey = l_suppkey join nation on n_nationkey = s_nationkey
),
happenings as (
  select e.*, n.n_name, cast(regexp_replace(props, '[^0-9]', '', 'g') as bigint) as k
  from events e join nation n on n.n_nationkey = e.user_id % 25
),
issues as (
  select n_name as repository, event_id as issue_number, 'u' || user_id as author_login,
    if(event_type in ('error', 'view'), 'open', 'closed') as state, ts as created_at,
    case when event_type not in ('error', 'view')
      then ts + to_minutes(cast(floor(value * 10) as integer)) end as closed_at,
    k as comment_count
  from happenings
),
rels as (
  select o_orderkey as release_id, n_name as repository, 'v' || o_orderkey as tag_name,
    'Version ' || o_orderkey as release_name,
    case when o_orderstatus <> 'O' then o_orderdate end as published_at, o_orderdate as loaded_at
  from by_nation
),
pr_tags as (
  select b.n_name as repository, l.l_orderkey as pr_number, p.p_type as label_name, p.p_brand as label_color
  from lineitem l join part p on p.p_partkey = l.l_partkey join by_nation b on b.o_orderkey = l.l_orderkey
),
issue_tags as (
  select n_name as repository, event_id as issue_number, event_type as label_name, 'ff0000' as label_color
  from happenings
  union all
  select n_name, event_id, 'area-' || cast(floor(k / 10) as bigint), event_type from happenings
),
downloads as (
  select 'pkg' || (user_id % 30) as package, ts::date as day, count(*) as downloads
  from events where event_type <> 'error' group by all
),
seed as (
  select n_name as repo, case when n_regionkey <> 4 then 'pkg' || n_nationkey end as package from nation
),
captures as (
  select n_nationkey::bigint as repository_id, n_name as repository_name,
    date_trunc('month', o_orderdate)::date as capture_date,
    count(distinct o_custkey) as stars, count(*) as forks,
    count(*) filter (where o_orderstatus = 'O') as open_issues
  from by_nation group by 1, 2, 3
)"""

_MARTS = """
dim_dates as (
  select cast(strftime(d, '%Y%m%d') as integer) as date_key, d::date as full_date,
    date_trunc('month', d)::timestamp as month
  from generate_series(timestamp '1995-01-01', timestamp '2030-12-31', interval 1 day) g(d)
),
dim_repositories as (
  select md5(repository_id || '-' || opened) as repository_key, repository_id, repository_name,
    lower(repository_name) as name, 'nations' as owner_login, 'as of ' || y as description,
    if(repository_id % 2 = 0, 'Python', 'Rust') as language, 'MIT' as license_spdx,
    'topic' || y as topics, timestamp '1990-01-01' as created_at, opened as updated_at,
    if(nth = 1, date '1900-01-01', opened::date) as valid_from,
    coalesce(closed::date, date '9999-12-31') as valid_to, closed is null as is_current
  from (
    select *, row_number() over w as nth, lead(opened) over w as closed
    from (select distinct n_nationkey::bigint as repository_id, n_name as repository_name,
            year(o_orderdate) as y, date_trunc('year', o_orderdate)::timestamp as opened
          from by_nation)
    window w as (partition by repository_id order by opened)
  )
),
dim_contributors as (
  select md5(username) as contributor_key, username, first_commit_date, last_commit_date,
    coalesce(total_commits, 0) as total_commits, coalesce(opened, 0) as total_prs_opened,
    coalesce(merged, 0) as total_prs_merged, coalesce(projects, 0) as distinct_projects_count,
    primary_project
  from (select author_login as username from commits where author_login is not null
        union select author_login from pulls union select author_login from issues) people
  left join (
    select author_login, min(committed_at)::date as first_commit_date,
      max(committed_at)::date as last_commit_date, count(*) as total_commits,
      count(distinct repository) as projects
    from commits group by 1) c on c.author_login = username
  left join (
    select author_login, count(*) as opened, count(merged_at) as merged
    from pulls group by 1) p on p.author_login = username
  left join (
    select author_login, repository as primary_project
    from (select author_login, repository, count(*) as n from commits group by 1, 2)
    qualify row_number() over (partition by author_login order by n desc, repository) = 1
  ) top on top.author_login = username
),
dim_labels as (
  select md5(label_name) as label_key, label_name, max(label_color) as label_color
  from (select label_name, label_color from issue_tags union all select label_name, label_color from pr_tags)
  group by label_name
),
fct_commits as (
  select md5(c.repository || '-' || commit_sha) as commit_key, r.repository_key, p.contributor_key,
    cast(strftime(committed_at, '%Y%m%d') as integer) as date_key, commit_sha as commit_hash,
    committed_at, committed_at as _loaded_at
  from commits c
  left join dim_repositories r on r.repository_name = c.repository
    and r.valid_from <= c.committed_at::date and c.committed_at::date < r.valid_to
  left join dim_contributors p on p.username = c.author_login
),
fct_pull_requests as (
  select md5(x.repository || '-' || pr_number) as pr_key, r.repository_key, p.contributor_key as author_key,
    cast(strftime(x.created_at, '%Y%m%d') as integer) as opened_date_key,
    cast(strftime(x.merged_at, '%Y%m%d') as integer) as merged_date_key,
    x.merged_at is not null as is_merged, date_diff('hour', x.created_at, x.merged_at) as time_to_merge_hours
  from pulls x
  left join dim_repositories r on r.repository_name = x.repository
    and r.valid_from <= x.created_at::date and x.created_at::date < r.valid_to
  left join dim_contributors p on p.username = x.author_login
),
fct_issues as (
  select md5(x.repository || '-' || issue_number) as issue_key, r.repository_key,
    p.contributor_key as author_key,
    cast(strftime(x.created_at, '%Y%m%d') as integer) as opened_date_key,
    cast(strftime(x.closed_at, '%Y%m%d') as integer) as closed_date_key,
    x.state = 'closed' as is_closed, date_diff('hour', x.created_at, x.closed_at) as time_to_close_hours,
    x.comment_count
  from issues x
  left join dim_repositories r on r.repository_name = x.repository
    and r.valid_from <= x.created_at::date and x.created_at::date < r.valid_to
  left join dim_contributors p on p.username = x.author_login
),
fct_releases as (
  select md5(x.repository || '-' || release_id) as release_key, r.repository_key,
    cast(strftime(published_at, '%Y%m%d') as integer) as date_key, tag_name, release_name,
    published_at, loaded_at as _loaded_at
  from rels x
  left join dim_repositories r on r.repository_name = x.repository
    and r.valid_from <= x.published_at::date and x.published_at::date < r.valid_to
  where published_at is not null
),
fct_daily_downloads as (
  select md5(d.package || '-' || d.day) as download_key, d.package, r.repository_key,
    cast(strftime(d.day, '%Y%m%d') as integer) as date_key, d.downloads as download_count
  from downloads d left join seed s on s.package = d.package
  left join dim_repositories r on r.repository_name = s.repo and r.valid_from <= d.day and d.day < r.valid_to
),
fct_repository_metrics as (
  select md5(c.repository_id || '-' || capture_date) as metric_key, c.repository_id, c.repository_name,
    r.repository_key, cast(strftime(capture_date, '%Y%m%d') as integer) as date_key,
    stars, forks, open_issues
  from captures c left join dim_repositories r on r.repository_name = c.repository_name
    and r.valid_from <= capture_date and capture_date < r.valid_to
),
activity as (
  select author_login as username, committed_at as moment, 'commit' as activity_type from commits
  union all select author_login, created_at, 'pr_opened' from pulls
  union all select author_login, merged_at, 'pr_merged' from pulls where merged_at is not null
  union all select author_login, created_at, 'issue_opened' from issues
  union all select author_login, closed_at, 'issue_closed' from issues where closed_at is not null
),
contributor_activity as (
  select username, moment::date as event_date, date_trunc('month', moment)::timestamp as event_month, activity_type
  from activity where username is not null
),
monthly as (
  pivot (select username, event_month, activity_type from contributor_activity)
  on activity_type in ('commit', 'pr_opened', 'pr_merged', 'issue_opened', 'issue_closed')
  using count(*) group by username, event_month
),
fct_contributor_activity_monthly as (
  select md5(contributor_key || '-' || event_month) as activity_key, contributor_key, username, event_month,
    cast(strftime(event_month, '%Y%m%d') as integer) as month_date_key,
    "commit" as commits, pr_opened as prs_opened, pr_merged as prs_merged,
    issue_opened as issues_opened, issue_closed as issues_closed
  from monthly join dim_contributors using (username)
),
bridge_issue_labels as (
  select distinct md5(repository || '-' || issue_number) as issue_key, label_key
  from issue_tags join dim_labels using (label_name)
),
named as (select repository_key, repository_name from dim_repositories),
commit_share as (
  select repository_name, username, count(*) as commits
  from fct_commits join named using (repository_key) join dim_contributors using (contributor_key)
  group by all
),
first_months as (
  select contributor_key, event_month, min(event_month) over (partition by contributor_key) as cohort_month
  from fct_contributor_activity_monthly
),
retention_cohort as (
  select cohort_month, date_diff('month', cohort_month, event_month) as months_since, count(*) as active,
    any_value(size) as cohort_size, count(*) / any_value(size) as retention
  from first_months
  join (select cohort_month, count(distinct contributor_key) as size from first_months group by 1)
    using (cohort_month)
  group by 1, 2
),
latest_metrics as (
  select * from fct_repository_metrics
  qualify row_number() over (partition by repository_name order by date_key desc, metric_key desc) = 1
),
release_gaps as (
  select repository_name, gap_days from (
    select repository_name, date_diff('day',
      lag(published_at) over (partition by repository_name order by published_at), published_at) as gap_days
    from fct_releases join named using (repository_key))
  where gap_days is not null
),
label_breakdown as (
  select label_name, count(*) as issues, count(*) filter (where not is_closed) as open,
    count(*) filter (where is_closed) as closed
  from bridge_issue_labels join fct_issues using (issue_key) join named using (repository_key)
  join dim_labels using (label_key)
  group by 1 order by issues desc, label_name limit 15
),
downloads_vs_stars as (
  select repository_name, stars, coalesce(download_count, 0) as downloads
  from latest_metrics left join (
    select repository_name, download_count from fct_daily_downloads join named using (repository_key)
    qualify row_number() over (partition by repository_name order by date_key desc, package desc) = 1
  ) using (repository_name)
),
health_components as (
  select r.repository_name,
    (select count(*) from fct_commits f join named n using (repository_key)
      where n.repository_name = r.repository_name
        and committed_at >= timestamp '2001-08-15' - interval 90 day) as commits_90d,
    coalesce((select avg(is_merged::int) from fct_pull_requests f join named n using (repository_key)
      join dim_dates d on d.date_key = opened_date_key
      where n.repository_name = r.repository_name
        and full_date >= timestamp '2001-08-15' - interval 365 day), 0) as pr_merge_rate,
    coalesce((select avg(is_closed::int) from fct_issues f join named n using (repository_key)
      join dim_dates d on d.date_key = opened_date_key
      where n.repository_name = r.repository_name
        and full_date >= timestamp '2001-08-15' - interval 365 day), 0) as issue_close_rate,
    (select date_diff('day', max(published_at), timestamp '2001-08-15') from fct_releases f
      join named n using (repository_key) where n.repository_name = r.repository_name) as days_since_release,
    coalesce((select stars from latest_metrics m where m.repository_name = r.repository_name), 0) as stars
  from dim_repositories r where is_current
),
scores as (
  select repository_name,
    least(ln(1 + commits_90d) / ln(91), 1) as c_activity,
    greatest(least(pr_merge_rate, 1), 0) as c_pr_responsiveness,
    greatest(least(issue_close_rate, 1), 0) as c_issue_management,
    coalesce(pow(0.5, days_since_release / 180.0), 0) as c_release_recency,
    least(ln(1 + stars) / ln(50001), 1) as c_popularity
  from health_components
),
first_load as (
  select o_orderkey, o_custkey, o_orderdate, o_totalprice, 1::bigint as load
  from orders where o_orderdate < '1999-06-01'
),
second_load as (
  select o_orderkey, o_custkey, o_orderdate, o_totalprice + 1 as o_totalprice, 2::bigint as load
  from orders where o_orderdate >= '1998-06-01'
)"""

PRELUDE = f"with {_VIEWS.strip()},{_MARTS}\n"

_FINAL: dict[str, str] = {
    "date_keys": """
select pr_number, cast(strftime(created_at, '%Y%m%d') as integer) as opened_key,
  cast(strftime(merged_at, '%Y%m%d') as integer) as merged_key,
  date_trunc('month', created_at)::timestamp as opened_month,
  date_diff('hour', created_at, merged_at) as hours, date_diff('day', created_at, merged_at) as days,
  date_diff('month', created_at, merged_at) as months
from pulls""",
    "dim_dates": """
select cast(strftime(d, '%Y%m%d') as integer) as date_key, d::date as full_date, year(d) as year,
  quarter(d) as quarter, month(d) as month, monthname(d) as month_name, day(d) as day_of_month,
  dayofweek(d) as day_of_week, dayname(d) as day_name, dayofweek(d) in (0, 6) as is_weekend,
  week(d) as week_of_year
from (select unnest(generate_series(min(o_orderdate)::date, max(o_orderdate)::date, interval 1 day)) as d
      from orders)""",
    "scd2_as_of_join": """
select p.repository, p.pr_number, r.repository_key, r.description
from pulls p left join dim_repositories r on r.repository_name = p.repository
  and r.valid_from <= p.created_at::date and p.created_at::date < r.valid_to""",
    "package_downloads_daily": """
select package as _package, strftime(day, '%Y-%m-%d') as date, downloads from downloads""",
    "topics_string": """
select source as repository_name, string_agg(distinct lang, ',' order by lang) as topics, count(*) as stars
from documents group by 1""",
    "label_child_rows": """
select user_id, value, count(*) as n from (
  select user_id, event_type as value from events union all
  select user_id, 'k' || length(props) from events) group by all""",
    "non_merge_commits": """
select concat_ws('-', conv_id, turn) as commit_sha, role as repository, role as author_login
from conversations where turn <= 1""",
    "all_repo_names": "select repository_name from dim_repositories where is_current",
    "overview_kpis": """
select (select count(distinct repository_name) from named) as repos, c.commits, c.contributors,
  p.prs, p.pr_merge_rate, i.issues, i.issue_close_rate,
  (select count(*) from fct_releases join named using (repository_key)) as releases,
  (select sum(stars)::bigint from latest_metrics) as stars,
  (select sum(forks)::bigint from latest_metrics) as forks
from (select count(*) as commits, count(distinct contributor_key) as contributors
      from fct_commits join named using (repository_key)) c,
  (select count(*) as prs, avg(is_merged::int) as pr_merge_rate
      from fct_pull_requests join named using (repository_key)) p,
  (select count(*) as issues, avg(is_closed::int) as issue_close_rate
      from fct_issues join named using (repository_key)) i""",
    "repo_snapshot": """
select repository_name, language, license_spdx, topics, created_at, stars, forks, open_issues
from dim_repositories left join (select repository_name, stars, forks, open_issues from latest_metrics)
  using (repository_name)
where is_current""",
    "commits_per_month": """
select month, repository_name, count(*) as commits
from fct_commits join dim_dates using (date_key) join named using (repository_key) group by all""",
    "stars_forks_over_time": """
select full_date as date, repository_name, stars, forks, open_issues
from fct_repository_metrics join dim_dates using (date_key)""",
    "downloads_over_time": """
select full_date as date, package, download_count as downloads
from fct_daily_downloads join dim_dates using (date_key) join named using (repository_key)""",
    "downloads_vs_stars": "select * from downloads_vs_stars",
    "health_components": "select * from health_components",
    "pr_velocity_monthly": """
select month, repository_name, median(time_to_merge_hours) as median_merge_hours
from fct_pull_requests join dim_dates on date_key = merged_date_key join named using (repository_key)
where is_merged group by 1, 2""",
    "pr_throughput_monthly": """
select month, repository_name, count(*) as opened, count(*) filter (where is_merged) as merged,
  avg(is_merged::int) as merge_rate
from fct_pull_requests join dim_dates on date_key = opened_date_key join named using (repository_key)
group by 1, 2""",
    "issue_resolution_monthly": """
select month, repository_name, median(time_to_close_hours) as median_close_hours,
  avg(is_closed::int) as close_rate
from fct_issues join dim_dates on date_key = opened_date_key join named using (repository_key)
group by 1, 2""",
    "issue_label_breakdown": "select * from label_breakdown",
    "commit_share": "select * from commit_share",
    "contributor_leaderboard": """
select username, sum(commits)::bigint as commits, count(distinct repository_name) as projects
from commit_share group by 1 order by commits desc, username limit 20""",
    "retention_cohort": "select * from retention_cohort",
    "active_contributors_monthly": """
select event_month as month, count(*) as active,
  count(*) filter (where event_month = cohort_month) as new_contributors,
  count(*) filter (where event_month > cohort_month) as returning_contributors
from first_months group by 1""",
    "multi_project_contributors": """
select username, total_commits, total_prs_opened, total_prs_merged, distinct_projects_count, primary_project
from dim_contributors where distinct_projects_count > 1""",
    "releases": """
select repository_name, tag_name, release_name, published_at
from fct_releases join named using (repository_key)""",
    "release_gaps": "select * from release_gaps",
    "date_bounds": """
select min(full_date) as first_day, max(full_date) as last_day from dim_dates
where date_key in (select date_key from fct_commits union select opened_date_key from fct_pull_requests
  union select opened_date_key from fct_issues union select date_key from fct_releases)""",
    "pr_velocity_between": """
select month, repository_name, median(time_to_merge_hours) as median_merge_hours
from fct_pull_requests join dim_dates on date_key = merged_date_key join named using (repository_key)
where is_merged and full_date between '1997-03-15' and '1999-06-20' group by 1, 2""",
    "commits_per_month_of_region": """
select month, repository_name, count(*) as commits
from fct_commits join dim_dates using (date_key) join named using (repository_key)
where repository_name in (select n_name from nation where n_regionkey = 1) group by all""",
    "flattened_records": """
select o_orderkey as id, o_custkey as owner__id, o_orderstatus as owner__status__code,
  o_orderpriority as owner__status__priority
from orders""",
    "cursor_per_group": """
select s.* from second_load s
left join (select o_custkey, max(o_orderdate) as mark from first_load group by 1) using (o_custkey)
where mark is null or s.o_orderdate >= mark""",
    "bus_factor": """
select repository_name, 1 + count(*) filter (where running < total / 2) as bus_factor
from (select repository_name, sum(commits) over (partition by repository_name) as total,
        sum(commits) over (partition by repository_name order by commits desc, username
                           rows unbounded preceding) as running
      from commit_share)
group by 1""",
    "lorenz_curve": """
select repository_name, row_number() over w / count(*) over (partition by repository_name) as contributor_frac,
  (sum(commits) over w)::double / (sum(commits) over (partition by repository_name))::double as commit_frac
from commit_share
window w as (partition by repository_name order by commits, username rows unbounded preceding)
union all select distinct repository_name, 0.0::double, 0.0::double from commit_share""",
    "retention_heatmap": """
select *, strftime(cohort_month, '%Y-%m') as cohort from retention_cohort
where months_since <= 24
qualify dense_rank() over (order by cohort_month desc) <= 36""",
    "release_cadence": """
select repository_name, median(gap_days) as gap_days from release_gaps group by 1""",
    "release_gap_histogram": """
select repository_name, (floor(gap_days / step) * step)::bigint as bin_start, count(*) as releases
from release_gaps, (
  select min(s) as step from (
    select unnest([1, 2, 5, 10, 20, 50, 100, 200, 500, 1000, 2000, 5000]) as s),
    (select min(gap_days) as lo, max(gap_days) as hi from release_gaps)
  where floor(hi / s) - floor(lo / s) + 1 <= 40)
group by 1, 2""",
    "label_states_long": """
select label_name, 'open' as state, open as issues from label_breakdown
union all select label_name, 'closed', closed from label_breakdown""",
    "series_status": """
select count(distinct full_date) as periods,
  case count(distinct full_date) when 0 then 'none' when 1 then 'single' else 'trend' end as status
from fct_repository_metrics join dim_dates using (date_key)""",
    "downloads_ready": """
select coalesce(sum(downloads), 0)::bigint as downloads, coalesce(sum(downloads), 0) > 0 as ready
from downloads_vs_stars""",
    "health_score": """
select repository_name, round(c_activity, 9) as c_activity,
  round(c_pr_responsiveness, 9) as c_pr_responsiveness, round(c_issue_management, 9) as c_issue_management,
  round(c_release_recency, 9) as c_release_recency, round(c_popularity, 9) as c_popularity,
  round((0.3 * c_activity + 0.2 * c_pr_responsiveness + 0.2 * c_issue_management
    + 0.15 * c_release_recency + 0.15 * c_popularity) * 100, 9) as health_score
from scores""",
    "keyed_upsert": """
select * from second_load
union all select * from first_load where o_orderkey not in (select o_orderkey from second_load)""",
    "keyed_delete_insert": """
select * from second_load
union all select * from first_load where o_custkey not in (select o_custkey from second_load)""",
    "incremental_watermark": """
, bounded as (
  select * from second_load where o_orderdate >= (select max(o_orderdate) from first_load))
select * from bounded
union all select * from first_load where o_orderkey not in (select o_orderkey from bounded)""",
    "late_days_dropped": """
select o_orderdate, count(*) as orders from second_load
where o_orderdate < (select max(o_orderdate) from first_load) group by 1""",
    "scd2_history": """
, seen as (
  select c_custkey, c_name,
    case when c_acctbal < 0 then 'ARREARS' when c_nationkey <> 3 then c_mktsegment end as segment
  from customer where c_mktsegment <> 'MACHINERY'),
known as (select c_custkey, c_name, c_mktsegment from customer where c_mktsegment <> 'BUILDING')
select k.*, timestamp '2024-01-01' as dbt_valid_from,
  case when s.c_custkey is not null and s.segment is distinct from k.c_mktsegment
    then timestamp '2024-02-01' end as dbt_valid_to
from known k left join seen s using (c_custkey)
union all
select s.c_custkey, s.c_name, s.segment, timestamp '2024-02-01', null
from seen s left join known k using (c_custkey)
where k.c_custkey is null or s.segment is distinct from k.c_mktsegment""",
    "dq_not_null": "select commit_sha from commits where author_login is null",
    "dq_unique": "select author_login, count(*) as n_rows from issues group by 1 having count(*) > 1",
    "dq_unique_combination": """
select repository, pr_number, label_name, count(*) as n_rows from pr_tags group by 1, 2, 3 having count(*) > 1""",
    "dq_accepted_values": """
select event_id, event_type from events where event_type not in ('view', 'click', 'signup')""",
    "dq_relationships": """
select o_custkey, count(*) as n_rows from orders
where o_custkey not in (select c_custkey from customer where c_acctbal > 0) group by 1""",
    "dq_ranges": """
select * from (
  select *, lead(opened) over (partition by n_nationkey order by opened) as next_lower
  from (select distinct n_nationkey, published_at::date as opened, published_at::date + 30 as closed
        from rels join nation on n_name = repository where published_at is not null))
where next_lower <> closed""",
    "dq_row_count": "select count(*) as n_rows from fct_issues having count(*) not between 1 and 1000",
    "dq_between": """
select issue_key, time_to_close_hours from fct_issues
where is_closed and time_to_close_hours not between 0 and 24""",
    "dq_expression": """
select metric_key, stars, forks, open_issues from fct_repository_metrics
where stars * 2 < forks + open_issues""",
    "dq_calendar": """
select * from (
  select full_date, lead(full_date) over (order by full_date) as next_date
  from (select distinct published_at::date as full_date from rels where published_at is not null))
where next_date <> full_date + 1""",
    "dq_freshness": """
select "table", newest, age_seconds,
  case when age_seconds > 86400 then 'error' when age_seconds > 43200 then 'warn' else 'pass' end as status
from (
  select "table", newest, date_sub('second', newest, timestamp '2024-01-31 18:00:00') as age_seconds
  from (select 'events' as "table", max(ts) as newest from events
        union all select 'releases', max(loaded_at) from rels))""",
    "dq_run_checks": """
select "check", severity, violations, if(violations = 0, 'pass', severity) as status from (
  select 'row_count(1,10000000)' as "check", 'error' as severity,
    (count(*) not between 1 and 10000000)::bigint as violations from fct_issues
  union all select 'not_null(issue_key)', 'error', count(*) - count(issue_key) from fct_issues
  union all select 'unique(issue_key)', 'error', count(*)
    from (select 1 from fct_issues group by issue_key having count(*) > 1)
  union all select 'not_null(repository_key)', 'error', count(*) - count(repository_key) from fct_issues
  union all select 'between(time_to_close_hours,0,None)', 'warn',
    count(*) filter (where time_to_close_hours < 0) from fct_issues
  union all select 'between(time_to_close_hours,0,24)', 'warn',
    count(*) filter (where is_closed and time_to_close_hours not between 0 and 24) from fct_issues
  union all select 'expression(comment_count >= 0)', 'error',
    count(*) filter (where comment_count < 0) from fct_issues
  union all select 'expression(comment_count < 50)', 'error',
    count(*) filter (where comment_count >= 50) from fct_issues
  union all select 'relationships(author_key)', 'error', count(*) from fct_issues
    where author_key is not null and author_key not in (select contributor_key from dim_contributors))""",
    "row_counts": """
select 'region' as "table", count(*) as n from region union all
select 'nation' as "table", count(*) as n from nation union all
select 'customer' as "table", count(*) as n from customer union all
select 'supplier' as "table", count(*) as n from supplier union all
select 'part' as "table", count(*) as n from part union all
select 'orders' as "table", count(*) as n from orders union all
select 'lineitem' as "table", count(*) as n from lineitem union all
select 'events' as "table", count(*) as n from events union all
select 'documents' as "table", count(*) as n from documents union all
select 'embeddings' as "table", count(*) as n from embeddings union all
select 'pages' as "table", count(*) as n from pages union all
select 'benchmark' as "table", count(*) as n from benchmark union all
select 'labels' as "table", count(*) as n from labels union all
select 'conversations' as "table", count(*) as n from conversations""",
    **{
        mart: f"select * from {mart}"
        for mart in (
            "dim_contributors",
            "dim_repositories",
            "dim_labels",
            "fct_commits",
            "fct_pull_requests",
            "fct_issues",
            "fct_releases",
            "fct_daily_downloads",
            "fct_repository_metrics",
            "fct_contributor_activity_monthly",
            "bridge_issue_labels",
            "contributor_activity",
        )
    },
}

# Landed records, stated over the tables themselves.
_LOADED = "timestamp '2024-01-10' as _loaded_at"
_DATED = "case when l_returnflag <> 'R' then l_shipdate end"
_PER_PACKAGE = """
select 'pkg' || (user_id % 30) as _package, strftime(ts, '%Y-%m-%d') as date, count(*) as downloads
from events where event_type <> 'error'"""
_TRUE_ISSUE = "event_type <> 'view'"

_FINAL |= {
    "stg_repositories": f"""
select s_suppkey as repository_id, 'trade/' || s_name as repository_name, s_name as name, 'trade' as owner_login,
  case when s_acctbal > 0 then 'solvent' end as description, floor(s_acctbal)::bigint as stars,
  s_nationkey::bigint as forks, 0::bigint as open_issues, 'SQL' as language,
  case when s_suppkey % 2 = 0 then 'MIT' end as license_spdx,
  case when s_suppkey % 3 <> 0 then 'Alum,n' || s_nationkey || ',zinc' end as topics,
  timestamp '2020-01-01' as created_at, timestamp '2024-01-01' as updated_at, {_LOADED}
from supplier""",
    "stg_commits": f"""
select concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) as commit_sha, 'lines/all' as repository,
  's' || l_suppkey as author_login, 'n' as author_name, 'e' as author_email, {_DATED} as committed_at,
  l_linestatus as message, {_LOADED}
from lineitem where l_linenumber <= 2""",
    "stg_issues": f"""
select 'events/' || event_type as repository, event_id as issue_number,
  case when user_id % 7 <> 0 then 'u' || user_id end as author_login,
  if(event_type = 'error', 'open', 'closed') as state, date_trunc('second', ts)::timestamp as created_at,
  case when event_type <> 'error' then date_trunc('second', ts)::timestamp end as closed_at,
  user_id as comment_count, {_LOADED}
from events where {_TRUE_ISSUE}""",
    "stg_issue_labels": f"""
select 'events/' || event_type as repository, event_id as issue_number, event_type as label_name, 'red' as label_color
from events where {_TRUE_ISSUE} and event_type <> 'click'
union all select 'events/' || event_type, event_id, props, event_type from events where {_TRUE_ISSUE} and event_type <> 'click'""",
    "stg_pull_requests": f"""
select 'orders/all' as repository, o_orderkey as pr_number, 'c' || o_custkey as author_login,
  if(o_orderstatus = 'O', 'open', 'closed') as state, o_orderdate as created_at,
  case when o_orderstatus = 'F' then o_orderdate end as merged_at, {_LOADED}
from orders""",
    "stg_pr_labels": """
select 'orders/all' as repository, o_orderkey as pr_number, o_orderstatus as label_name, 'blue' as label_color from orders
union all select 'orders/all', o_orderkey, o_orderpriority, 'grey' from orders""",
    "stg_releases": f"""
select p_partkey as release_id, 'parts/all' as repository, p_name as tag_name, p_type as name,
  case when p_size <= 40 then timestamp '2023-05-06 07:08:09' end as published_at, {_LOADED}
from part""",
    "landed_provenance": """
select endpoint, owner, date '2024-01-10' as day, records, repos from (
  select 'repositories' as endpoint, 'trade' as owner, count(*) as records, count(distinct s_name) as repos from supplier
  union all select 'commits', 'lines', count(*), 1 from lineitem
  union all select 'issues', 'events', count(*), count(distinct event_type) from events
  union all select 'pull_requests', 'orders', count(*), 1 from orders
  union all select 'releases', 'parts', count(*), 1 from part)""",
    "snap_repositories": """
with seen as (
  select s_suppkey as repository_id, floor(s_acctbal)::bigint as stars, s_suppkey % 5 = 0 as changed,
    case when s_suppkey % 3 <> 0 then 'Alum,n' || s_nationkey || ',zinc' end as topics
  from supplier)
select repository_id, topics, stars, timestamp '2024-01-10' as dbt_valid_from,
  case when changed then timestamp '2024-01-11' end as dbt_valid_to from seen
union all select repository_id, 'renewed', stars + 1, timestamp '2024-01-11', null from seen where changed""",
    "tracked_targets": """
select 'repo' as kind, n_name as target from nation
union all select 'package', 'pkg' || n_nationkey from nation where n_regionkey <> 4""",
    "downloads_of_packages": f"""{_PER_PACKAGE}
  and ts::date in (date '2024-01-03', date '2024-01-05') and user_id % 30 in (1, 2, 29) group by all""",
    "downloads_of_no_package": f"{_PER_PACKAGE} and false group by all",
    "membership_lists": """
select 'list' as kind, count(*) as n from orders where o_orderpriority in ('2-HIGH', '5-LOW')
union all select 'frame', count(*) from orders where o_orderpriority like '1%'
union all select 'empty', 0 union all select 'all', count(*) from orders""",
    "repeated_day": f"""
with early as ({_PER_PACKAGE} and hour(ts) < 12 group by all),
again as ({_PER_PACKAGE} and ts::date = date '2024-01-04' group by all)
select *, 1 as load from early anti join again using (_package, date) union all select *, 2 from again""",
    "metric_captures": """
select s_suppkey as repository_id, 'trade/' || s_name as repository_name, day as date_key,
  floor(s_acctbal)::bigint + more as stars, s_nationkey::bigint as forks, load
from supplier, (values (20240110, 1, 0), (20240111, 3, 2)) v(day, more, load)""",
    "cursor_null_kept": f"""
with c as (select {_DATED} as dated from lineitem)
select dated is null as undated, count(*) as n from c
where dated is null or dated >= (select max(dated) from c where dated < timestamp '1998-01-01') group by 1""",
    "undated_partition": f"""
select coalesce(strftime({_DATED}, '%Y-%m'), '0000-00') as _month, count(*) as n from lineitem group by 1""",
    "upsert_equal_version": """
select l_orderkey, 1 as version, l_shipdate as landed, l_linenumber as page, l_partkey from lineitem
qualify row_number() over (partition by l_orderkey order by l_shipdate desc, l_linenumber desc, l_partkey desc) = 1""",
    "retention_heatmap_full": "select *, strftime(cohort_month, '%Y-%m') as cohort from retention_cohort",
    "ordered_snapshot": """
select row_number() over (order by stars desc nulls last, repository_name) as position, repository_name, stars
from dim_repositories left join (select repository_name, stars from latest_metrics) using (repository_name)
where is_current""",
    "ordered_label_breakdown": """
select row_number() over (order by issues desc, label_name) as position, * from label_breakdown""",
    "ordered_leaderboard": """
select row_number() over (order by commits desc, username) as position, * from (
  select username, sum(commits)::bigint as commits, count(distinct repository_name) as projects
  from commit_share group by 1 order by commits desc, username limit 20)""",
    "ordered_names": """
select row_number() over (order by repository_name) as position, repository_name from dim_repositories where is_current""",
    "provenance_stamp": """
select 'a/a' as _repo, n_nationkey, timestamp '2024-01-10 03:00:00' as _loaded_at from nation""",
}

# What a replay of loads ends with is what all rows give.
_FINAL |= {
    "replayed_contributors": _FINAL["dim_contributors"],
    "replayed_activity_monthly": _FINAL["fct_contributor_activity_monthly"],
    "replayed_pull_requests": _FINAL["fct_pull_requests"],
    "replayed_labels": _FINAL["dim_labels"],
    "asof_by_ordered_merge": _FINAL["scd2_as_of_join"],
    "numbered_orders": """
select row_number() over (order by o_totalprice desc nulls last, o_orderkey) as position, o_orderkey, o_totalprice
from orders""",
    "bitmap_contributors": """
select repository, count(distinct author_login) as contributors from commits where author_login is not null group by 1""",
    "bitmap_contributors_monthly": """
select date_trunc('month', committed_at)::date as month, count(distinct author_login) as contributors
from commits where author_login is not null group by 1""",
    "bitmap_contributors_between": """
select count(distinct author_login) as contributors from commits
where date_trunc('month', committed_at) between date '1997-03-01' and date '1999-06-01'""",
    "issue_midpoints": """
select repository, median(epoch_us(created_at::timestamp)) as midpoint_us from issues group by 1""",
    "issue_midpoint_overall": """
select median(epoch_us(created_at::timestamp)) as midpoint_us from issues""",
}

# Queries that begin with names of their own, without the views.
_OWN = {"snap_repositories", "repeated_day", "cursor_null_kept"}

ORACLE: dict[str, str] = {
    name: final.strip() if name in _OWN else f"{PRELUDE}{final.strip()}" for name, final in _FINAL.items()
}
