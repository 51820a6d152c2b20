"""The expected answer of every query as SQL, written apart from the Spark code."""

from __future__ import annotations

_ORDERS = (
    "orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey "
    "join region on n_regionkey = r_regionkey"
)
_SHIPMENTS = "lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey"
_PRICE = "cast(sum(cast(floor(o_totalprice) as bigint)) as bigint)"
_QUANTITY = "cast(sum(l_quantity) as bigint)"
_QUARTER = "cast(date_trunc('quarter', o_orderdate) as date)"
_DIRTY = (
    "case when l_quantity < 3 then '--' when l_quantity > 45 "
    "then concat('1,', lpad(cast(cast(l_quantity as int) as varchar), 3, '0')) "
    "else cast(cast(l_quantity as int) as varchar) end"
)
_CENSUS_ORDER = f"{_ORDERS} where year(o_orderdate) in (1995, 2000)"


def _place(column: str) -> str:
    clean = f"regexp_replace(trim({column}), '^\\(\\d+\\)\\s*', '')"
    return f"case {clean} when 'NATION_21' then 'NATION_20' when 'NATION_22' then 'NATION_2' else {clean} end"


def _pct(n: str, total: str) -> str:
    return f"cast((({n}) * 2000 + ({total})) // (2 * nullif({total}, 0)) as double) / 10"


VIEWS = {
    "fx_population": f"select {_QUARTER} as ref_date, r_name as geo, {_PRICE} as population from {_ORDERS} group by 1, 2",
    "fx_npr": (
        f"select {_QUARTER} as ref_date, r_name as geo, o_orderpriority as npr_type, {_PRICE} as cnt "
        f"from {_ORDERS} where o_orderstatus = 'P' group by 1, 2, 3"
    ),
    "fx_census": (
        "select cast(year(o_orderdate) as int) as census_year, r_name as geo, case o_orderstatus "
        "when 'F' then 'canadian_born' when 'O' then 'naturalized' else 'permanent_resident' end as status, "
        f"count(*) as cnt from {_CENSUS_ORDER} group by 1, 2, 3"
    ),
    "fx_permits": (
        "select case l_returnflag when 'A' then 'study' when 'N' then 'work' else 'asylum' end as stream, "
        f"cast(year(l_shipdate) as int) as ref_year, n_name as country, {_QUANTITY} as cnt from {_SHIPMENTS} "
        "where l_returnflag in ('A', 'N') or (l_returnflag = 'R' and year(l_shipdate) >= 1998) group by 1, 2, 3"
    ),
    "fx_pr": (
        "select cast(year(o_orderdate) as int) as ref_year, n_name as country, count(*) as cnt "
        f"from {_ORDERS} group by 1, 2"
    ),
    "fx_naturalized": (
        f"select cast(year(o_orderdate) as int) as census_year, n_name as country, {_QUANTITY} as cnt "
        f"from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey "
        "join nation on c_nationkey = n_nationkey where year(o_orderdate) in (1995, 2000) group by 1, 2"
    ),
    "fx_country_raw": (
        "select cast(year(l_shipdate) as varchar) as en_year, case when s_nationkey % 10 = 3 "
        "then concat('(', cast(s_nationkey as varchar), ') ', n_name) when s_nationkey = 7 then null else n_name end "
        f"as en_country, {_DIRTY} as total from {_SHIPMENTS}"
    ),
    "fx_programs_raw": (
        "select cast(year(l_shipdate) as varchar) as en_year, case p_size % 8 "
        "when 0 then '  Temporary  Foreign Worker Program ' when 1 then 'International Mobility Program' "
        "when 2 then 'TFWP low wage' when 3 then 'IMP' when 4 then concat('Seasonal Agricultural', chr(9), 'Worker') "
        "when 5 then 'Open Work Permit' when 6 then '' else concat(p_type, ' ', p_name) end as en_program, "
        f"p_size % 8 as kind, {_DIRTY} as total from lineitem join part on l_partkey = p_partkey"
    ),
    "fx_programs": (
        "select cast(en_year as int) as ref_year, case when kind in (0, 2, 4) then 'tfwp' "
        "when kind in (1, 3, 5) then 'imp' else 'other' end as program_stream, "
        "cast(coalesce(sum(try_cast(replace(total, ',', '') as bigint)), 0) as bigint) as cnt "
        "from fx_programs_raw group by 1, 2"
    ),
    "fx_census_raw": (
        "with places as (select year(o_orderdate) as census_year, r_name as geo, o_orderstatus, o_orderpriority, "
        f"n_name, initcap_name from {_ORDERS} join (select r_regionkey as k, array_to_string(list_transform("
        "string_split(lower(r_name), ' '), lambda w: concat(upper(w[1]), w[2:])), ' ') as initcap_name from region) "
        "on k = r_regionkey where year(o_orderdate) in (1995, 2000)) "
        "select cast(census_year as int) as census_year, geo, o_orderstatus, place, count(*) as total, "
        "count(*) filter (o_orderpriority = '1-URGENT') as immigrant, "
        "count(*) filter (o_orderpriority = '2-HIGH') as temporary "
        "from (select *, unnest(['Total - Place of birth', initcap_name, concat('South ', initcap_name), n_name]) "
        "as place from places) group by 1, 2, 3, 4"
    ),
    "fx_sheet": (
        "select c_mktsegment as sheet, c_custkey + 5 as row_idx, n_name as country, y as ref_year, "
        "sum(cast(floor(o_totalprice) as bigint)) filter (year(o_orderdate) = y) as n "
        "from (select * from customer join nation on c_nationkey = n_nationkey), "
        "(select distinct cast(year(o_orderdate) as int) as y from orders) left join orders on o_custkey = c_custkey "
        "where c_custkey % 5 <> 0 and c_custkey % 7 <> 0 group by c_mktsegment, c_custkey, n_name, y"
    ),
    "fx_source_loads": (
        "select event_id as load_id, user_id as run_id, event_type as dataset_key, "
        "case when value < 3 then 'failed' else 'success' end as status, "
        "case when value < 3 then null else props end as reference_period, ts as loaded_at from events"
    ),
    "fx_category_weights": (
        "select 'naturalized' as category, country, cnt from fx_naturalized where census_year = 2000 "
        "union all select 'permanent_resident', country, cnt from fx_pr where ref_year = 2000"
    ),
    "fx_part_weights": (
        "select l_returnflag as category, concat('Part#', lpad(cast(l_partkey as varchar), 9, '0')) as part, "
        "count(*) as cnt from lineitem group by 1, 2"
    ),
    # -- canonical places ------------------------------------------------------
    "pr_places": f"select ref_year, {_place('country')} as country, sum(cnt) as cnt from fx_pr group by 1, 2",
    "nat_places": f"select census_year, {_place('country')} as country, sum(cnt) as cnt from fx_naturalized group by 1, 2",
    "permit_places": f"select stream, ref_year, {_place('country')} as country, sum(cnt) as cnt from fx_permits group by 1, 2, 3",
    # -- streams ---------------------------------------------------------------
    "streams_now": (
        "select ref_date, npr_type as stream, sum(cnt) as cnt, sum(sum(cnt)) over () as total from fx_npr "
        "where geo = 'ASIA' and ref_date = (select max(ref_date) from fx_npr where geo = 'ASIA') group by 1, 2"
    ),
    "stream_history": (
        "select ref_date as date, npr_type as stream, cast(sum(cnt) as bigint) as count, true as has_source, "
        "'quarterly' as cadence, 'statcan' as source_origin from fx_npr where geo = 'ASIA' group by 1, 2 "
        "union all select make_date(y.ref_year, 1, 1), s.name, cast(coalesce(sum(f.cnt), 0) as bigint), "
        "count(f.cnt) > 0, 'annual', 'ircc' from (select distinct ref_year from fx_permits where stream = 'study' "
        "and ref_year >= 1995 and ref_year < 2000) y cross join (values ('study', 'annual_study_permit_holders'), "
        "('work', 'annual_work_permit_holders'), ('asylum', 'annual_asylum_claimants')) s(stream, name) "
        "left join fx_permits f on f.ref_year = y.ref_year and f.stream = s.stream group by y.ref_year, s.name"
    ),
    # -- status ----------------------------------------------------------------
    "status_inputs": (
        "select (select population from fx_population where geo = 'ASIA' order by ref_date desc limit 1) as population, "
        "(select max(ref_date) from fx_population where geo = 'ASIA') as pop_date, "
        "(select sum(cnt) from fx_npr where geo = 'ASIA' and ref_date = (select max(ref_date) from fx_npr "
        "where geo = 'ASIA')) as npr, (select max(ref_date) from fx_npr where geo = 'ASIA') as npr_date, "
        "(select max(census_year) from fx_census where geo = 'ASIA') as census_year"
    ),
    "status_weights": (
        "select status, cnt, greatest(i.population - i.npr, 0) as target, i.* from fx_census c, status_inputs i "
        "where geo = 'ASIA' and c.census_year = i.census_year"
    ),
    "status_scaled": (
        "select *, target * cnt // sum(cnt) over () as base, "
        "row_number() over (order by (target * cnt) % total desc, cnt desc, status) as rn, "
        "target - sum(target * cnt // total) over () as left_over "
        "from (select *, sum(cnt) over () as total from status_weights)"
    ),
    "status_rows": (
        "select 'actual' as mode, status, cnt as n, make_date(census_year, 1, 1) as ref_date, "
        "'Statistics Canada 98-10-0302-01' as source from status_scaled union all "
        "select 'estimated', status, base + case when rn <= left_over then 1 else 0 end, pop_date, "
        "'Estimated from latest population + census resident shares' from status_scaled union all "
        "select m, 'non_permanent_resident', npr, npr_date, 'Statistics Canada 17-10-0121-01' "
        "from status_inputs, (values ('actual'), ('estimated')) t(m)"
    ),
    "status_named": (
        "select *, case status when 'canadian_born' then 'Canadian-born Citizens' when 'naturalized' "
        "then 'Naturalized Citizens' when 'permanent_resident' then 'Permanent Residents' "
        "else 'Temporary Residents' end as label, sum(n) over (partition by mode) as total from status_rows"
    ),
    # -- origin ----------------------------------------------------------------
    "origin_years": (
        "select 'permanent_resident' as stream, coalesce(max(ref_year) filter (ref_year < 2001), max(ref_year)) as y "
        "from fx_pr union all select stream, coalesce(max(ref_year) filter (ref_year < 2001), max(ref_year)) "
        "from fx_permits group by 1 union all select 'naturalized', max(census_year) from fx_naturalized"
    ),
    "origin_weights": (
        "select category, country, sum(cnt) as cnt from ("
        "select 'naturalized' as category, country, cnt from nat_places where census_year = "
        "(select y from origin_years where stream = 'naturalized') union all "
        "select 'permanent_resident', country, cnt from pr_places where ref_year = "
        "(select y from origin_years where stream = 'permanent_resident') union all "
        "select 'temporary_resident', country, cnt from permit_places p join origin_years o on p.stream = o.stream "
        "and p.ref_year = o.y) where country <> 'NATION_24' and cnt > 0 group by 1, 2"
    ),
    "origin_targets": (
        "select case status when 'non_permanent_resident' then 'temporary_resident' else status end as category, "
        "greatest(n, 0) as target from status_rows where mode = 'estimated' and status <> 'canadian_born'"
    ),
    "origin_scaled": (
        "select category, country, target, base + case when row_number() over (partition by category "
        "order by rest desc, cnt desc, country) <= target - sum(base) over (partition by category) "
        "then 1 else 0 end as n from (select *, target * cnt // total as base, (target * cnt) % total as rest "
        "from (select w.*, target, sum(cnt) over (partition by w.category) as total "
        "from origin_weights w join origin_targets t on w.category = t.category))"
    ),
    "origin_ranked": (
        "select *, row_number() over (partition by category order by n desc, country) as rank "
        "from origin_scaled where n > 0"
    ),
    "origin_rest": (
        "select t.category, t.target, greatest(t.target - coalesce(sum(n), 0), 0) as rest from origin_targets t "
        "left join (select * from origin_ranked where rank <= 10) r on t.category = r.category group by 1, 2"
    ),
    "foreign_mix": (
        "select country, sum(n) as n from (select country, n from origin_ranked where rank <= 10 union all "
        "select concat('Non-top-10 ', case category when 'naturalized' then 'Naturalized' "
        "when 'permanent_resident' then 'Permanent Residents' else 'Temporary Residents' end), rest "
        "from origin_rest) group by 1 having sum(n) > 0"
    ),
    "foreign_top": "select country, n, row_number() over (order by n desc, country) as rank from foreign_mix",
    "overview_rows": (
        "select category, rank, country, n from origin_ranked where rank <= 10 union all "
        "select 'foreign_born_total', rank, country, n from foreign_top where rank <= 10"
    ),
    "overview_heads": (
        "select category, target as total, rest as non_top from origin_rest union all "
        "select 'foreign_born_total', (select sum(target) from origin_targets), greatest((select sum(target) "
        "from origin_targets) - (select sum(n) from foreign_top where rank <= 10), 0)"
    ),
    "year_texts": (
        "select max(y) filter (stream = 'naturalized') as nat, max(y) filter (stream = 'permanent_resident') as pr, "
        "max(y) filter (stream = 'study') as study, max(y) filter (stream = 'work') as work, "
        "max(y) filter (stream = 'asylum') as asylum from origin_years"
    ),
}

_USES = {
    "fx_programs": ["fx_programs_raw"],
    "fx_category_weights": ["fx_naturalized", "fx_pr"],
    "pr_places": ["fx_pr"],
    "nat_places": ["fx_naturalized"],
    "permit_places": ["fx_permits"],
    "streams_now": ["fx_npr"],
    "stream_history": ["fx_npr", "fx_permits"],
    "status_inputs": ["fx_population", "fx_npr", "fx_census"],
    "status_weights": ["fx_census", "status_inputs"],
    "status_scaled": ["status_weights"],
    "status_rows": ["status_scaled", "status_inputs"],
    "status_named": ["status_rows"],
    "origin_years": ["fx_pr", "fx_permits", "fx_naturalized"],
    "origin_weights": ["nat_places", "pr_places", "permit_places", "origin_years"],
    "origin_targets": ["status_rows"],
    "origin_scaled": ["origin_weights", "origin_targets"],
    "origin_ranked": ["origin_scaled"],
    "origin_rest": ["origin_targets", "origin_ranked"],
    "foreign_mix": ["origin_ranked", "origin_rest"],
    "foreign_top": ["foreign_mix"],
    "overview_rows": ["origin_ranked", "foreign_top"],
    "overview_heads": ["origin_rest", "origin_targets", "foreign_top"],
    "year_texts": ["origin_years"],
}


def _sql(views: str, select: str) -> str:
    """The select with all views it needs, directly or not, as named subqueries."""
    ordered: list[str] = []

    def need(name: str) -> None:
        for other in _USES.get(name, []):
            need(other)
        if name not in ordered:
            ordered.append(name)

    for name in views.split():
        need(name)
    if not ordered:
        return select
    return "with " + ",\n".join(f"{n} as ({VIEWS[n]})" for n in ordered) + "\n" + select


_LABELLED = "case stream when '3-MEDIUM' then 'Medium' when '5-LOW' then 'Low' else stream end"
_SERIES = (
    "1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW",
    "annual_study_permit_holders", "annual_work_permit_holders", "annual_asylum_claimants",
)


def _apportion(view: str, key: str) -> str:
    return _sql(
        view,
        f"""select category, {key}, cnt as count, cast(base + case when row_number() over (partition by category
        order by rest desc, cnt desc, {key}) <= target - sum(base) over (partition by category) then 1 else 0 end
        as bigint) as scaled from (select *, target * cnt // total as base, (target * cnt) % total as rest from (
        select *, total * 7 // 3 + 1 as target from (
        select *, sum(cnt) over (partition by category) as total from {view})))""",
    )


def _compact(n: str, decimals: int = 2) -> str:
    scale = 10**decimals
    step = 1_000_000 // scale
    return (
        f"case when {n} >= 1000000 then concat(({n} + {step // 2}) // {step} // {scale}, '.', "
        f"lpad(cast((({n} + {step // 2}) // {step}) % {scale} as varchar), {decimals}, '0'), 'M') "
        f"when {n} >= 1000 then concat(({n} + 500) // 1000, 'K') else format('{{:,}}', {n}) end"
    )


_RULES_LOW = "lower(trim(regexp_replace(en_program, '\\s+', ' ', 'g')))"
_COUNT = "try_cast(replace(case when total = '--' then null else total end, ',', '') as bigint)"
_LATEST_LOADS = (
    "select * from fx_source_loads where dataset_key in ({keys}) "
    "qualify row_number() over (partition by dataset_key order by loaded_at desc, load_id desc) = 1"
)
_LOADED_AT = "regexp_replace(strftime(loaded_at, '%Y-%m-%d %H:%M:%S.%f'), '\\.000000$', '')"

ORACLE = {
    "population_latest": _sql(
        "fx_population",
        "select ref_date, population from fx_population where geo = 'ASIA' order by ref_date desc limit 1",
    ),
    "population_history": _sql(
        "fx_population",
        "select ref_date as date, population from fx_population where geo = 'ASIA' and ref_date >= date '2000-01-01'",
    ),
    "population_year_window": _sql(
        "fx_population",
        "select ref_date as date, population from fx_population where geo = 'ASIA' "
        "and year(ref_date) between 1997 and 1999",
    ),
    "population_years": _sql(
        "fx_population",
        "select distinct cast(year(ref_date) as int) as year from fx_population where geo = 'ASIA' "
        "and ref_date >= date '1995-01-01'",
    ),
    "quarter_start_dates": f"select distinct {_QUARTER} as ref_date from orders",
    "streams_latest_share": _sql(
        "streams_now",
        f"select ref_date, stream, cast(cnt as bigint) as count, cast(total as bigint) as total, "
        f"{_pct('cnt', 'total')} as pct from streams_now",
    ),
    "streams_history_blended": _sql("stream_history", "select * from stream_history"),
    "streams_pivot": _sql(
        "stream_history",
        "select date, "
        + ", ".join(f"cast(sum(count) filter (stream = '{s}') as bigint) as \"{s}\"" for s in _SERIES)
        + " from stream_history where year(date) between 1996 and 1999 group by 1",
    ),
    "streams_grouped": _sql(
        "streams_now",
        f"select label, cast(n as bigint) as count, cast(total as bigint) as total, {_pct('n', 'total')} as pct from ("
        f"select {_LABELLED} as label, cnt as n, total from streams_now where stream not in ('1-URGENT', '2-HIGH') union all "
        # The combined bar is there without a row, too.
        "select 'First class', coalesce(sum(cnt) filter (stream in ('1-URGENT', '2-HIGH')), 0), any_value(total) from streams_now)",
    ),
    "streams_grouped_absent": _sql(
        "streams_now",
        f"select label, cast(n as bigint) as count, cast(total as bigint) as total, {_pct('n', 'total')} as pct from ("
        f"select {_LABELLED} as label, cnt as n, total from streams_now union all "
        "select 'None', 0, (select any_value(total) from streams_now))",
    ),
    "stream_panels": _sql(
        "streams_now",
        f"select panel, label, cast(cnt as bigint) as count, cast(t as bigint) as total, {_pct('cnt', 't')} as pct "
        f"from (select *, sum(cnt) over (partition by panel) as t from (select case when stream in ('1-URGENT', "
        f"'2-HIGH') then 'First' else 'Second' end as panel, {_LABELLED} as label, coalesce(s.cnt, 0) as cnt from "
        "(values ('1-URGENT'), ('2-HIGH'), ('3-MEDIUM'), ('5-LOW'), ('9-NONE')) w(stream) left join streams_now s using (stream)))",
    ),
    "status_actual_and_estimated": _sql(
        "status_named",
        "select 'ASIA' as geo, mode, status, label, cast(n as bigint) as count, ref_date, source, "
        "(select population from status_inputs) as population, cast(total as bigint) as mode_total from status_named",
    ),
    "status_pivot": _sql(
        "fx_census",
        "select census_year as year, "
        + ", ".join(
            f"cast(sum(cnt) filter (status = '{s}') as bigint) as {s}"
            for s in ("canadian_born", "naturalized", "permanent_resident")
        )
        + " from fx_census where geo = 'ASIA' group by 1",
    ),
    "status_share": _sql(
        "status_named",
        f"select status, label, cast(n as bigint) as count, cast(total as bigint) as total, {_pct('n', 'total')} as pct "
        "from status_named where mode = 'estimated'",
    ),
    "mode_select": _sql(
        "status_named",
        "select status, case status when 'canadian_born' then 'Canadian-born' when 'naturalized' "
        "then 'Naturalized Citizen' when 'permanent_resident' then 'Permanent Resident' "
        "else 'Non-Permanent Resident' end as label, cast(n as bigint) as count, cast(total as bigint) as total, "
        f"{_pct('n', 'total')} as pct from status_named where mode = 'actual'",
    ),
    "population_load": (
        f"select ref_date, geo, population from (select {_QUARTER} as ref_date, r_name as geo, "
        "cast(floor(o_totalprice) as bigint) as population, row_number() over (partition by "
        f"{_QUARTER}, r_name order by o_orderkey) as rn from {_ORDERS} where r_name = 'ASIA') where rn = 1"
    ),
    "npr_load": (
        f"select ref_date, geo, npr_type, count from (select {_QUARTER} as ref_date, r_name as geo, "
        "case o_orderpriority when '1-URGENT' then 'urgent' when '2-HIGH' then 'high' when '3-MEDIUM' then 'medium' "
        "else 'not_specified' end as npr_type, cast(floor(o_totalprice) as bigint) as count, row_number() over ("
        f"partition by {_QUARTER}, r_name, o_orderpriority order by o_orderkey) as rn from {_ORDERS} "
        "where o_orderpriority <> '5-LOW') where rn = 1"
    ),
    "status_fanout": _sql(
        "fx_census_raw",
        "select * from (select census_year, geo, case o_orderstatus when 'F' then 'canadian_born' when 'O' "
        "then 'naturalized' else 'permanent_resident' end as status, cast(case o_orderstatus when 'P' "
        "then nullif(immigrant, 0) else total end as bigint) as count from fx_census_raw "
        "where place = 'Total - Place of birth' union all select census_year, geo, 'non_permanent_resident', "
        "nullif(temporary, 0) from fx_census_raw where place = 'Total - Place of birth' and o_orderstatus = 'P') "
        "where count is not null",
    ),
    "naturalized_region_filter": _sql(
        "fx_census_raw",
        "select census_year, place as country, cast(total as bigint) as count from fx_census_raw where geo = 'AFRICA' "
        "and o_orderstatus = 'O' and place not in ('Total - Place of birth', 'Africa')",
    ),
    "country_annual": _sql(
        "fx_country_raw",
        "select cast(en_year as int) as ref_year, en_country as country, cast(coalesce(sum("
        f"{_COUNT}), 0) as bigint) as count, 0 as ref_month from fx_country_raw where en_country is not null group by 1, 2",
    ),
    "country_annual_clean": _sql(
        "fx_country_raw",
        f"select cast(en_year as int) as ref_year, {_place('en_country')} as country, cast(coalesce(sum({_COUNT}), 0) "
        "as bigint) as count from fx_country_raw where en_country is not null group by 1, 2",
    ),
    "null_token_audit": _sql(
        "fx_country_raw",
        "select cast(en_year as int) as ref_year, count(*) as n_rows, count(*) filter (total = '--') as n_suppressed, "
        "count(*) filter (contains(total, ',')) as n_commas, count(try_cast(total as bigint)) as n_strict, "
        "cast(coalesce(sum(try_cast(total as bigint)), 0) as bigint) as sum_strict, "
        f"count({_COUNT}) as n_lenient, cast(coalesce(sum({_COUNT}), 0) as bigint) as sum_lenient "
        "from fx_country_raw group by 1",
    ),
    "programs_annual": _sql(
        "fx_programs", "select ref_year, program_stream, cnt as count, 0 as ref_month from fx_programs"
    ),
    "programs_latest_share": _sql(
        "fx_programs",
        f"select ref_year, program_stream as stream, cnt as count, cast(t as bigint) as total, {_pct('cnt', 't')} as pct, "
        "case program_stream when 'tfwp' then 'Temporary Foreign Worker Program' when 'imp' "
        "then 'International Mobility Program' else 'Other / Unmapped' end as label "
        "from (select *, sum(cnt) over () as t from fx_programs where ref_year = (select max(ref_year) from fx_programs))",
    ),
    "unpivot_year_totals": _sql(
        "fx_sheet",
        "select sheet, row_idx, ref_year, 0 as ref_month, country, '_' as province, cast(n as bigint) as count from fx_sheet",
    ),
    "promote_header": (
        "with years as (select cast(y as varchar) as name, cast(row_number() over (order by y) + 1 as int) as col_idx from "
        "(select distinct year(o_orderdate) as y from orders)) "
        "select sheet, cast(2 as bigint) as header_row, col_idx, name from (select distinct c_mktsegment as sheet from customer), "
        "(select col_idx, name from years union all select 0, 'Country' union all select 1, 'Category' "
        "union all select cast(max(col_idx) + 1 as int), 'Notes' from years)"
    ),
    "catalog_best_resource": (
        "select * from (select p_brand as dataset_id, p_partkey as id, p_name as name, p_type as description, "
        "case when p_size % 2 = 0 then 'csv' else 'xlsx' end as format, p_size as last_modified, "
        "cast(case when p_size % 2 = 0 then 1 else 0 end + case when contains(hay, 'ring') then 2 else 0 end "
        "+ case when contains(hay, 'small') then 2 else 0 end + case when contains(hay, 'red') then 2 else 0 end "
        "+ case when contains(hay, 'economy') then 2 else 0 end as int) as score from "
        "(select *, lower(concat(p_name, ' ', p_type)) as hay from part) where contains(hay, 'e')) where score >= 2 "
        "qualify row_number() over (partition by dataset_id order by score desc, last_modified desc, name desc, id) = 1"
    ),
    "dedupe_keep_first": (
        "select * exclude (rn) from (select *, row_number() over (partition by l_orderkey, l_linenumber order by "
        "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) "
        "as rn from lineitem) where rn = 1"
    ),
    "key_violations": (
        "select l_orderkey, l_linenumber, count(*) as n_rows, count(*) filter (l_orderkey is null or l_linenumber "
        "is null or l_quantity is null) as n_null_rows from lineitem group by 1, 2 having count(*) > 1"
    ),
    "latest_complete_year": _sql(
        "fx_pr fx_permits",
        "select s.stream, s.ref_year, cast(sum(s.cnt) as bigint) as period_total from (select 'permanent' as stream, "
        "ref_year, cnt from fx_pr union all select stream, ref_year, cnt from fx_permits) s join (select stream, "
        "coalesce(max(ref_year) filter (ref_year < 2001), max(ref_year)) as y from (select 'permanent' as stream, "
        "ref_year from fx_pr union all select stream, ref_year from fx_permits) group by 1) l "
        "on s.stream = l.stream and s.ref_year = l.y group by 1, 2",
    ),
    "origin_top10": _sql(
        "pr_places",
        "select ref_year, country, cast(cnt as bigint) as count from pr_places where ref_year = (select max(ref_year) "
        "from pr_places where ref_year < 2001) and country <> 'NATION_24' order by cnt desc, country limit 10",
    ),
    "origin_top10_history": _sql(
        "pr_places",
        "select ref_year as year, country, cast(cnt as bigint) as count from pr_places where country in (select country "
        "from pr_places where country <> 'NATION_24' group by country order by sum(cnt) desc, country limit 10)",
    ),
    "origin_countries_pivot": _sql(
        "pr_places",
        "select ref_year as year, "
        + ", ".join(
            f"any_value(c.names[{i}]) as country_{i}, cast(sum(cnt) filter (country = c.names[{i}]) as bigint) as count_{i}"
            for i in range(1, 11)
        )
        + " from pr_places, (select list(country order by total desc, country) as names from (select country, sum(cnt) as total "
        "from pr_places group by country order by total desc, country limit 10)) c "
        "where ref_year between 1996 and 2000 and list_contains(c.names, country) group by 1",
    ),
    "origin_top_rows": _sql(
        "pr_places",
        "select ref_year as year, country, cast(cnt as bigint) as count from pr_places where ref_year between 1997 and "
        "1999 and country in (select country from pr_places group by country order by sum(cnt) desc, country limit 5)",
    ),
    "origin_total_trend": _sql(
        "pr_places",
        "select ref_year as year, cast(sum(cnt) as bigint) as total from pr_places where ref_year between 1996 and 2000 "
        "and country in (select country from pr_places where country <> 'NATION_24' group by country "
        "order by sum(cnt) desc, country limit 10) group by 1",
    ),
    "temp_top10_by_stream": _sql(
        "permit_places",
        "select stream, ref_year, country, cast(cnt as bigint) as count, cast(rank as int) as rank from (select p.*, "
        "row_number() over (partition by p.stream order by cnt desc, country) as rank from permit_places p join "
        "(select stream, coalesce(max(ref_year) filter (ref_year < 2001), max(ref_year)) as y from permit_places "
        "group by 1) l on p.stream = l.stream and p.ref_year = l.y where country <> 'NATION_24') where rank <= 10",
    ),
    "naturalized_top10": _sql(
        "nat_places",
        "select census_year as year, country, cast(cnt as bigint) as count from nat_places where census_year = "
        "(select max(census_year) from nat_places) and country <> 'NATION_24' order by cnt desc, country limit 10",
    ),
    "naturalized_all": _sql(
        "nat_places", "select census_year as year, country, cast(cnt as bigint) as count from nat_places"
    ),
    "merge_counts": _sql(
        "permit_places pr_places",
        "select country, cast(sum(cnt) as bigint) as count from (select country, cnt from permit_places "
        "union all select country, cnt from pr_places) group by 1",
    ),
    "apportion_by_category": _apportion("fx_category_weights", "country"),
    "apportion_large_groups": _apportion("fx_part_weights", "part"),
    "topk_with_other": _sql(
        "fx_pr",
        "select ref_year, case when rn <= 5 then country else 'Non-top-10' end as country, "
        "cast(sum(cnt) as bigint) as count from (select *, row_number() over (partition by ref_year "
        "order by cnt desc, country) as rn from fx_pr) group by 1, 2",
    ),
    "origin_overview": _sql(
        "overview_rows overview_heads year_texts",
        "select h.category, case h.category when 'foreign_born_total' then 'Foreign-born Total' when 'naturalized' "
        "then 'Naturalized Citizens' when 'permanent_resident' then 'Permanent Residents' else 'Temporary Residents' "
        "end as label, cast(total as bigint) as total, cast(non_top as bigint) as non_top, case h.category "
        "when 'foreign_born_total' then concat('Naturalized ', nat, ', PR ', pr, ', Temporary ', "
        "greatest(study, work, asylum)) when 'naturalized' then concat(nat, ' census distribution scaled to current "
        "estimated stock') when 'permanent_resident' then concat(pr, ' IRCC annual distribution scaled to current "
        "estimated stock') else concat('Study ', study, ', work ', work, ', asylum ', asylum) end as source_period, "
        "cast(rank as int) as rank, country, cast(n as bigint) as count "
        "from overview_heads h left join overview_rows r on h.category = r.category, year_texts",
    ),
    "category_select": _sql(
        "overview_rows overview_heads",
        "select category, country, cast(n as bigint) as count from overview_rows where category = 'temporary_resident' "
        "union all select category, 'Non-top-10', cast(non_top as bigint) from overview_heads "
        "where category = 'temporary_resident' and non_top > 0",
    ),
    "latest_load_per_key": _sql(
        "fx_source_loads",
        f"select dataset_key, reference_period, status, {_LOADED_AT} as loaded_at from ("
        + _LATEST_LOADS.format(keys="'click', 'error', 'view'")
        + ")",
    ),
    "freshness_summary": _sql(
        "fx_source_loads",
        f"select dataset_key, reference_period, status, {_LOADED_AT} as loaded_at, "
        "case when dataset_key = 'error' then 'no resource found' end as error, dataset_key = 'error' as failed_now, "
        "(select arg_max(reference_period, dataset_key) from latest where reference_period <> '') "
        "as latest_source_reference, (select reference_period from fx_source_loads where status = 'success' and "
        "dataset_key in ('click', 'error', 'purchase') and reference_period <> '' "
        "order by loaded_at desc, dataset_key desc, reference_period desc limit 1) as last_success_reference, "
        "true as stale from latest",
    ).replace("\nselect dataset_key, reference_period, status, regexp", ",\nlatest as ("
              + _LATEST_LOADS.format(keys="'click', 'error', 'purchase'")
              + ")\nselect dataset_key, reference_period, status, regexp"),
    "reference_period": _sql(
        "fx_population fx_pr",
        "select geo as dataset, concat(min(ref_date), ' to ', max(ref_date)) as reference_period from fx_population "
        "group by 1 union all select country, concat(min(ref_year), ' to ', max(ref_year)) from fx_pr group by 1 "
        "union all select 'nothing', 'Latest available'",
    ),
    "slice_replace": _sql(
        "fx_population",
        "select ref_date, geo, case when geo = 'ASIA' then 2 else 1 end * population as population from fx_population",
    ),
    "table_replace": _sql(
        "fx_naturalized", "select census_year, country, cnt as count from fx_naturalized where census_year = 2000"
    ),
    "mart_json": _sql(
        "pr_places",
        "select cast(null as varchar) as note, cast(row_number() over (order by cnt desc, country) - 1 as int) as place, "
        "country, cast(cnt as bigint) as count from (select * from pr_places where ref_year = 2000 "
        "and country <> 'NATION_24' order by cnt desc, country limit 10)",
    ),
    "count_labels": _sql(
        "fx_population",
        f"select ref_date, geo, {_compact('population')} as short, {_compact('population', 1)} as shorter, "
        f"{_compact('(population // 1000)')} as thousands, {_compact('(population // 1000000)')} as small, "
        "format('{:,}', population) as grouped from fx_population",
    ),
    "date_labels": _sql(
        "fx_population",
        "select ref_date, geo, case when month(ref_date) > 3 then strftime(ref_date, '%B %Y') else 'Date unavailable' "
        "end as month_label, cast(year(ref_date) as int) as year, make_date(year(ref_date), 1, 1) as year_start, "
        "strftime(ref_date, '%Y-%m-%d') as iso from fx_population",
    ),
    "month_numbers": (
        "select month, cast(month_number as int) as month_number, count(*) as n from (select case o_orderstatus "
        "when 'F' then strftime(o_orderdate, '%B') when 'O' then concat(' ', upper(strftime(o_orderdate, '%b')), '. ') "
        "else case month(o_orderdate) when 9 then 'sept' when 5 then '5' when 6 then 'Juin' when 7 then '13' when 8 then '-3' end "
        "end as month, "
        "case when o_orderstatus in ('F', 'O') or month(o_orderdate) in (5, 9) then month(o_orderdate) else 0 end "
        "as month_number from orders) group by 1, 2"
    ),
    "scalar_strings": _sql(
        "fx_programs_raw",
        "select trim(regexp_replace(en_program, '\\s+', ' ', 'g')) as squeezed, contains(low, 'work') as has_work, "
        "starts_with(low, 't') as t_first, ends_with(low, 't') as t_last, cast(length(low) as int) as length, "
        "left(low, 4) as first_four, replace(replace(low, 'foreign', 'f.'), 'worker', 'w.') as shortened, "
        "concat(coalesce(nullif(low, ''), 'n/a'), ' in ', en_year) as templated, case when kind in (0, 2, 4) "
        "then 'tfwp' when kind in (1, 3, 5) then 'imp' else 'other' end as program, low = '' as blank, count(*) as n "
        f"from (select *, {_RULES_LOW} as low from fx_programs_raw) group by all",
    ),
    "scalar_math": _sql(
        "fx_country_raw",
        "select en_year as \"EN_YEAR\", n, n as cut, greatest(n - 20, 0) as above_20, n % 7 as mod_7, "
        f"n / nullif(n % 3, 0) as ratio, {_pct('n', '1060')} as pct, cast(null as double) as no_pct, count(*) as n_rows "
        f"from (select en_year, {_COUNT} as n from fx_country_raw) where en_year is not null "
        "group by all",
    ),
    "counts_of_chosen_years": _sql(
        "fx_country_raw",
        f"select en_year as \"EN_YEAR\", cast(sum({_COUNT}) as bigint) as n from fx_country_raw "
        "where en_year in ('1996', '1998', '2000') group by 1",
    ),
    "positive_counts": _sql(
        "fx_country_raw",
        f"select en_year as \"EN_YEAR\", count(*) as n_rows, cast(sum(n - 10) as bigint) as above_10 from "
        f"(select en_year, {_COUNT} as n from fx_country_raw) where n > 10 group by 1",
    ),
    "nested_topk": _sql(
        "pr_places",
        "select ref_year, cast(rn - 1 as int) as place, country, cast(cnt as bigint) as count from (select *, "
        "row_number() over (partition by ref_year order by cnt desc, country) as rn from pr_places) where rn <= 2",
    ),
    "map_lookup": _sql(
        "streams_now",
        "select cast(sum(coalesce(cnt, 0)) over () as bigint) as together, w.stream, cast(coalesce(cnt, 0) as bigint) "
        "as count, cnt is not null as present from (values ('1-URGENT'), ('3-MEDIUM'), ('missing')) w(stream) "
        "left join streams_now s on s.stream = w.stream",
    ),
}

_BEST = ORACLE["catalog_best_resource"]
ORACLE |= {
    "catalog_pinned": (
        f"with pinned as (select p_brand as dataset_id, p_partkey as id, p_name as name, p_type as description, "
        "case when p_size % 2 = 0 then 'csv' else 'xlsx' end as format, p_size as last_modified, cast(null as int) as score from part "
        "where p_partkey in (7, 8) qualify row_number() over (partition by p_brand order by p_size desc, p_name desc, p_partkey) = 1) "
        f"select * from pinned union all select * from ({_BEST}) where dataset_id not in (select dataset_id from pinned)"
    ),
    "apportion_outlier": _sql(
        "fx_part_weights",
        """select category, part, count, cast(target // n + case when row_number() over (partition by category order by part)
        <= target % n then 1 else 0 end as bigint) as scaled from (select category, case part when 'Part#000000001' then 'A'
        else part end as part, cast(1 as bigint) as count, count(*) over (partition by category) as n,
        count(*) over (partition by category) * 7 // 3 + 1 as target from fx_part_weights)""",
    ),
    # -- documents: the marts' answers in the documents' shape -------------------
    "doc_population_current": (
        f"select population, ref_date, 'Statistics Canada 17-10-0009-01' as source, 'Quarterly' as frequency "
        f"from ({ORACLE['population_latest']})"
    ),
    "doc_population_history": ORACLE["population_history"],
    "doc_status_breakdown": (
        f"select mode, mode_total, status, label, count, ref_date, source from ({ORACLE['status_actual_and_estimated']})"
    ),
    "doc_census_snapshots": _sql(
        "fx_census", "select census_year as year, status, cast(cnt as bigint) as count from fx_census where geo = 'ASIA'"
    ),
    "doc_visa_streams_current": (
        "select ref_date, total as total_npr, cast(row_number() over (order by count desc, stream) - 1 as int) as place, "
        f"stream, count, pct from ({ORACLE['streams_latest_share']})"
    ),
    "doc_visa_streams_history": (
        f"select date, stream, count, cadence, source_origin from ({ORACLE['streams_history_blended']})"
    ),
    "doc_work_permit_sources": (
        "select true as available, ref_year, total, cast(row_number() over (order by count desc, stream) - 1 as int) as place, "
        f"stream, count, pct from ({ORACLE['programs_latest_share']})"
    ),
    "doc_origin_pr_current": (
        "select ref_year, cast(row_number() over (order by count desc, country) - 1 as int) as place, country, count "
        f"from ({ORACLE['origin_top10']})"
    ),
    "doc_origin_pr_history": ORACLE["origin_top10_history"],
    "doc_origin_temp_current": (
        f"select stream, ref_year, rank - 1 as place, country, count from ({ORACLE['temp_top10_by_stream']})"
    ),
    "doc_origin_naturalized": (
        "select year as latest_census_year, cast(row_number() over (order by count desc, country) - 1 as int) as place, "
        f"country, count from ({ORACLE['naturalized_top10']})"
    ),
    "doc_naturalized_all": ORACLE["naturalized_all"],
    "doc_origin_overview": (
        "select category, label, total, non_top as non_top_10, source_period, true as is_estimated, rank - 1 as place, "
        f"country, count from ({ORACLE['origin_overview']}) where country is not null"
    ),
    "doc_freshness": _sql(
        "fx_source_loads",
        "select * from (with named as (select *, case dataset_key when 'click' then 'population_quarterly' when 'error' then 'npr_by_type_quarterly' "
        "when 'view' then 'status_breakdown_census' end as name from fx_source_loads), "
        "latest as (select * from named where name is not null "
        "qualify row_number() over (partition by name order by loaded_at desc, load_id desc) = 1) "
        "select true as stale, (select reference_period from named where name is not null and status = 'success' and "
        "reference_period <> '' order by loaded_at desc, name desc, reference_period desc limit 1) as last_success_reference, "
        f"name as dataset_key, status, reference_period, {_LOADED_AT} as loaded_at from latest)",
    ),
    "refresh_log": (
        "with population as (" + ORACLE["population_load"].replace("'ASIA'", "'AFRICA'") + "), "
        "npr as (" + ORACLE["npr_load"] + "), status as (select * from (" + ORACLE["status_fanout"] + ") where geo = 'AFRICA'), country as (" + ORACLE["country_annual"] + "), "
        "programs as (" + ORACLE["programs_annual"] + "), "
        "naturalized as (" + ORACLE["naturalized_region_filter"] + ") "
        + " union all ".join(
            f"select '{key}' as dataset_key, 'success' as status, '{key} csv' as resource_name, "
            f"concat(min({at}), ' to ', max({at})) as reference_period, "
            f"count(*) as n_rows, cast(sum({value}) as bigint) as total from {view}"
            for key, view, at, value in (
                ("population_quarterly", "population", "ref_date", "population"),
                ("npr_by_type_quarterly", "npr", "ref_date", "count"),
                ("status_breakdown_census", "status", "census_year", "count"),
                ("naturalized_by_country_census", "naturalized", "census_year", "count"),
                ("work_permit_programs_monthly", "programs", "ref_year", "count"),
                ("permanent_residents_monthly", "country", "ref_year", "count"),
            )
        )
        + "".join(
            f" union all select '{key}', 'failed', null, null, null, null"
            for key in ("study_permits_monthly", "work_permits_monthly")
        )
    ),
}

_CELLS = """
with years as (select y, row_number() over (order by y) + 1 as col from (select distinct cast(year(o_orderdate) as int) as y from orders)),
last as (select max(col) + 1 as notes, max(y) as y from years),
people as (select * from customer join nation on c_nationkey = n_nationkey),
spent as (select o_custkey, year(o_orderdate) as y, cast(sum(cast(floor(o_totalprice) as bigint)) as bigint) as n from orders group by 1, 2),
cells as (
    select c_mktsegment as sheet, c_custkey + 5 as row_idx, 0 as col_idx, case when c_custkey % 7 = 0 then ' ' else n_name end as value, true as is_text from people
    union all select c_mktsegment, c_custkey + 5, 1, 'sub', true from people where c_custkey % 5 = 0
    union all select c_mktsegment, c_custkey + 5, col, coalesce(format('{:,}', n), '--'), true
        from people cross join years left join spent on o_custkey = c_custkey and spent.y = years.y
    union all select c_mktsegment, c_custkey + 5, notes, cast(c_custkey as varchar), false from people cross join last
    union all select sheet, 0, 0, 'Claimants by country', true from (select distinct c_mktsegment as sheet from people)
    union all select sheet, 2, col, name, true from (select distinct c_mktsegment as sheet from people)
        cross join (select 0 as col, 'Country' as name union all select 1, 'Category' union all select col, cast(y as varchar) from years union all select notes, 'Notes' from last)
    union all select sheet, 3, col, name, true from (select distinct c_mktsegment as sheet from people)
        cross join (select col, concat(y, ' Total') as name from years union all select notes, concat(y + 1, ' YTD') from last)
    union all select sheet, 4, 0, 'All countries', true from (select distinct c_mktsegment as sheet from people)
    union all select sheet, 4, col, cast(col - 1 as varchar), false from (select distinct c_mktsegment as sheet from people)
        cross join (select col from years union all select notes from last)
)
"""
_RUN_LOADS = {
    "population_quarterly": "success", "npr_by_type_quarterly": "success", "status_breakdown_census": "success",
    "naturalized_by_country_census": "failed", "study_permits_monthly": "failed", "work_permits_monthly": "failed",
    "work_permit_programs_monthly": "skipped", "asylum_claimants_monthly": "skipped", "permanent_residents_monthly": "failed",
}
_RUN_DOCUMENTS = {
    "population_current.json": 0, "population_history.json": 1, "status_breakdown.json": 1, "visa_streams_current.json": 0,
    "visa_streams_history.json": 1, "work_permit_sources_current.json": 0, "origin_pr_current.json": None, "origin_pr_history.json": 1,
    "origin_temp_current.json": 0, "origin_naturalized.json": None, "origin_overview.json": 0,
}
_PART = (
    "select *, p_partkey // 20 as number, concat('r', lpad(cast(p_partkey as varchar), 12, '0')) as id, "
    "case when p_size % 3 > 0 then p_type end as description, "
    "case when p_size % 2 = 0 then 'CSV' when p_size % 5 > 0 then 'xlsx' end as format, "
    "lpad(cast(p_size as varchar), 3, '0') as last_modified, lower(concat(p_name, ' ', coalesce(case when p_size % 3 > 0 then p_type end, ''))) as hay from part"
)

ORACLE |= {
    "grid_cells": _CELLS + "select sheet, cast(row_idx as bigint) as row_idx, cast(col_idx as int) as col_idx, value, is_text from cells",
    "grid_year_totals": ORACLE["unpivot_year_totals"],
    "unpivot_repeated_cells": _sql(
        "fx_sheet",
        "select sheet, row_idx, ref_year, 0 as ref_month, country, '_' as province, "
        "cast(case when row_idx % 3 = 0 then greatest(coalesce(n, 7), 7) else n end as bigint) as count from fx_sheet",
    ),
    "refresh_log": (
        ORACLE["refresh_log"]
        + " union all select 'asylum_claimants_monthly', 'success', 'asylum_claimants_monthly csv', concat(min(y), ' to ', max(y)), count(*), "
        "cast(sum(n) filter (n % 5 <> 0) as bigint) from (select y, n_nationkey, count(o_orderkey) as n from "
        "(select distinct year(o_orderdate) as y from orders) cross join nation "
        "left join (select * from orders join customer on o_custkey = c_custkey) on c_nationkey = n_nationkey and year(o_orderdate) = y group by 1, 2)"
    ),
    "rejected_rows": (
        "with good as (select cast(year(l_shipdate) as int) as ref_year, n_name as country, "
        f"sum(try_cast(replace({_DIRTY}, ',', '') as bigint)) as n from {_SHIPMENTS} where l_orderkey % 97 <> 0 and s_nationkey <> 7 group by 1, 2), "
        f"bad as (select count(*) as n_rejected from {_SHIPMENTS} where l_orderkey % 97 = 0) "
        "select 'study_permits_monthly' as dataset_key, 'success' as status, concat(n_rejected, ' malformed rows left out') as notes, "
        "'more fields than columns' as reason, n_rejected, (select count(*) from good) as n_rows, "
        "(select cast(sum(coalesce(n, 0)) as bigint) from good) as total from bad "
        "union all select 'work_permits_monthly', 'failed', null, 'more fields than columns', n_rejected, 0, null from bad"
    ),
    "load_metrics": _sql(
        "fx_pr fx_population fx_npr",
        " union all ".join(
            f"select '{key}' as dataset_key, count(*) as n_written, concat(min({at}), ' to ', max({at})) as period, "
            f"cast(0 as bigint) as n_null, count(*) as n_read from {view}"
            for key, view, at in (
                ("permanent_residents_monthly", "fx_pr", "ref_year"), ("population_quarterly", "fx_population", "ref_date"),
                ("npr_by_type_quarterly", "fx_npr", "ref_date"),
            )
        ),
    ),
    "latest_complete_year_pruned": ORACLE["latest_complete_year"],
    "origin_top10_pruned": ORACLE["origin_top10"],
    "temp_top10_pruned": ORACLE["temp_top10_by_stream"],
    "log_compaction": ORACLE["latest_load_per_key"],
    "catalog_scan": (
        "select concat('set ', number) as dataset_id, id, p_name as name, description, format, last_modified, cast(null as varchar) as url, score from "
        "(select *, cast(case when format = 'CSV' then 1 else 0 end + case when contains(hay, 'ring') then 2 else 0 end "
        "+ case when contains(hay, 'small') then 2 else 0 end + case when contains(hay, 'red') then 2 else 0 end "
        f"+ case when contains(hay, 'economy') then 2 else 0 end as int) as score from ({_PART}) "
        "where contains(hay, 'e') and number % 11 <> 3 and number % 13 <> 5) where score >= 2 "
        "qualify row_number() over (partition by number order by score desc, last_modified desc, p_name desc, id) = 1"
    ),
    "catalog_errors": (
        f"select case when number % 13 = 5 then 'not a package response' else 'the request has failed' end as error, count(distinct number) as n "
        f"from ({_PART}) where number % 13 = 5 or number % 11 = 3 group by 1"
    ),
    "refresh_run": (
        "with population as (" + ORACLE["population_load"] + ") select 'run' as part, 'run' as name, 'success' as status, cast(3 as bigint) as n"
        + "".join(f" union all select 'load', '{key}', '{status}', null" for key, status in _RUN_LOADS.items())
        + "".join(
            f" union all select 'document', '{name}', '{'skipped' if n is None else 'published'}', {'null' if n is None else n}"
            for name, n in _RUN_DOCUMENTS.items()
        )
        + " union all select 'view', geo, null, cast(sum(population) as bigint) from population where year(ref_date) = 1997 group by geo"
    ),
}
