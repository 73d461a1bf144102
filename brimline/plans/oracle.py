"""Oracle SQL for the registered queries, written the direct way: joins of rows to folds, frames over rows."""

SPLIT = "date '2000-01-01'"
MEASURES = """100.0 * sum(case when l_linestatus = 'F' then l_quantity else 0 end) / sum(l_quantity) as level,
  sum(l_quantity) as rain, avg(l_discount) * 100 as temp, sum(l_extendedprice) as demand"""
NATION_JOIN = "lineitem join supplier on s_suppkey = l_suppkey join nation on n_nationkey = s_nationkey"
SUFFIX = "DolulukOrani"
WEATHER = ("tmax", "tmin", "tavg", "hum", "wind", "sun", "evap", "prcp")
LAGS = (7, 14, 30, 60, 90)
HORIZONS = ((7, 30), (14, 60), (30, 90))


def _panel(entity, source="lineitem"):
    return f"select {entity} as entity, cast(l_shipdate as date) as date, {MEASURES} from {source} group by 1, 2"


FLAG = f"flag_panel as ({_panel('l_returnflag')})"
SUPPLIER = f"supplier_panel as ({_panel('concat(chr(83), cast(l_suppkey as varchar))')})"
REGION = f"""region_panel as ({_panel('r_name', NATION_JOIN + ' join region on r_regionkey = n_regionkey')})"""
STATION = f"""station_panel as (select n_name as station, cast(l_shipdate as date) as date, sum(l_quantity) as prcp,
  avg(l_discount) * 100 as tavg, max(l_tax) as tmax, min(l_tax) as tmin from {NATION_JOIN} group by 1, 2)"""
DIRTY = FLAG + """, dirty_panel as (select entity, date,
  case when entity = 'A' and date between date '1996-02-10' and date '1996-02-12' then 130.0
       when date = date '1997-05-05' then null else level end as level,
  case when day(date) = 11 then null else rain end as rain,
  case when day(date) = 17 then null else temp end as temp,
  demand, cast(null as double) as empty_col from flag_panel)"""
CLEAN = DIRTY + """, clean_panel as (select entity, date, case when level > 100 then null else level end as level,
  rain, temp, demand from dirty_panel)"""
CONFIG = """config as (select r_name as entity, ['demand', 'absent_series'] as prod_cols,
  list(n_name order by n_name) as weather_stations,
  case when r_regionkey in (0, 2, 4) then [7, 14, 30] end as lag_days,
  case r_regionkey when 1 then 'Dense' when 3 then 'LSTM' end as model,
  case r_regionkey when 2 then [10, 20, 30] when 4 then [15, 45] end as seq_lens,
  case r_regionkey when 3 then [180, 90] end as halflives,
  case r_regionkey when 1 then 'walkfwd_expanding' when 2 then 'rolling' end as strategy
  from nation join region on r_regionkey = n_regionkey group by r_name, r_regionkey)"""
SETTINGS = CONFIG + """, settings as (select entity, prod_cols, weather_stations,
  coalesce(lag_days, [7, 14, 30, 60, 90]) as lag_days, coalesce(model, 'GRU') as model,
  coalesce(seq_lens, [30, 60, 90]) as seq_lens, coalesce(halflives, [365]) as halflives,
  case when strategy in ('baseline', 'walkfwd_expanding') then strategy else 'baseline' end as strategy,
  coalesce(strategy, 'baseline') as requested_strategy from config)"""
CONFIG_TEXT = """entity, array_to_string(prod_cols, ',') as prod_cols,
  array_to_string(weather_stations, ',') as weather_stations, array_to_string(lag_days, ',') as lag_days, model,
  array_to_string(seq_lens, ',') as seq_lens, array_to_string(halflives, ',') as halflives, strategy"""
HORIZON_CONFIG = SETTINGS + """, horizon_config as (
  select entity, 7 as horizon, seq_lens[1] as seq_len, lag_days from settings where seq_lens[1] is not null
  union all select entity, 14, seq_lens[2], lag_days from settings where seq_lens[2] is not null
  union all select entity, 30, seq_lens[3], lag_days from settings where seq_lens[3] is not null)"""

W = "(partition by entity order by date)"


def r(expression, digits=6, name=None):
    """Rounded value; adding zero turns -0.0 into 0.0."""
    return f"round({expression}, {digits}) + 0.0 as {name or expression}"


def rows_before(k):
    return f"(partition by entity order by date rows between {k} preceding and 1 preceding)"


def days(function, column, k, key="entity"):
    return (f"{function}({column}) over (partition by {key} order by date "
            f"range between interval {k - 1} days preceding and current row)")


def lag(k):
    return f"lag(level, {k}) over {W}"


def mean_before(k):
    return f"case when count(level) over {rows_before(k)} = {k} then avg(level) over {rows_before(k)} end"


STD = f"case when count(level) over {rows_before(30)} = 30 then stddev_samp(level) over {rows_before(30)} end"
FILL = "(partition by entity order by date rows unbounded preceding)"
SEASONAL = {
    "month_sin": "sin(2 * pi() * month(date) / 12)", "month_cos": "cos(2 * pi() * month(date) / 12)",
    "doy_sin": "sin(2 * pi() * dayofyear(date) / 365)", "doy_cos": "cos(2 * pi() * dayofyear(date) / 365)",
}
RAW = {
    "level": "level", "rain": "rain", "temp": "temp", "demand": f"lag(demand, 1) over {W}",
    **{f"rain_{k}d": days("sum", "rain", k) for k in (7, 30, 90)}, "temp_7d": days("avg", "temp", 7),
    **{f"lag_{k}": lag(k) for k in LAGS},
    **{f"delta_{k}": f"{lag(7)} - {lag(7 + k)}" for k in (1, 7, 30)},
    **{f"rolling_mean_{k}": mean_before(k) for k in (30, 180, 365)}, "rolling_std_30": STD,
    "trend_direction": f"({mean_before(180)}) - ({mean_before(365)})", "rain_x_level": f"rain * {lag(7)}",
    **SEASONAL,
}


def frame(panel):
    """CTEs ending in `frame`: features on the raw level, fill, targets, complete rows."""
    raw = ", ".join(f"{e} as {n}" for n, e in RAW.items())
    fill = ", ".join(f"last_value({n} ignore nulls) over {FILL} as {n}" for n in RAW)
    lead = ", ".join(f"lead(level, {h}) over {W} as target_{h}" for h, _ in HORIZONS)
    whole = " and ".join(f"{n} is not null" for n in [*RAW, *(f"target_{h}" for h, _ in HORIZONS)])
    return f"""raw_features as (select entity, date, {raw} from {panel}),
filled as (select entity, date, {fill} from raw_features),
with_targets as (select *, {lead} from filled),
frame as (select * from with_targets where {whole})"""


FLAG_FRAME = FLAG + ", " + frame("flag_panel")
NATION_FLAG = f"nation_flag_panel as ({_panel('concat(n_name, chr(45), l_returnflag)', NATION_JOIN)})"
FRAME_COLUMNS = "entity, date, " + ", ".join(
    r(c, {"demand": 2, "rain_x_level": 4}.get(c, 6)) for c in [*RAW, "target_7", "target_14", "target_30"])


def roles(columns):
    """CTEs over `frame`: numbered rows per horizon, folds, and (row, fold) pairs with their role."""
    per_horizon = " union all ".join(
        f"select *, {h} as horizon, {n} as seq_len, target_{h} as target from numbered" for h, n in HORIZONS)
    return f""", numbered as (select entity, date, {columns}, target_7, target_14, target_30,
  row_number() over {W} as row_no, max(date) over (partition by entity) as last_date,
  row_number() over (partition by entity, date >= {SPLIT} order by date) as part_no from frame),
h as ({per_horizon}),
starts as (select range as fold, cast({SPLIT} + to_months(cast(6 * range as integer)) as date) as test_start,
  cast({SPLIT} + to_months(cast(6 * range + 6 as integer)) as date) as test_end from range(0, 40)),
pairs as (
  select h.*, 'baseline' as strategy, 0 as fold,
    case when date + horizon < {SPLIT} then 'train' when date >= {SPLIT} then 'test' end as role from h
  union all
  select h.*, 'walkfwd_expanding' as strategy, fold,
    case when date < test_start then 'train' when date < test_end then 'test' end as role
  from h join starts on test_start < last_date),
tagged as (select * from pairs where role is not null),
sizes as (select entity, strategy, horizon, seq_len, fold,
  count(*) filter (where role = 'train') as train_rows,
  count(*) filter (where role = 'train' and row_no >= seq_len) as train_samples,
  count(*) filter (where role = 'test') as test_rows,
  max(date) filter (where role = 'train') as latest from tagged group by all),
fold_sizes as (select *, train_rows >= seq_len + 10 and (strategy = 'baseline' or train_rows > 60) as usable
  from sizes where test_rows > 0),
train as (select t.*, f.train_samples, f.latest from tagged t join fold_sizes f
  using (entity, strategy, horizon, fold) where role = 'train' and usable),
test as (select t.* from tagged t join fold_sizes f using (entity, strategy, horizon, fold)
  where role = 'test' and usable and case when strategy = 'baseline' then part_no else row_no end >= t.seq_len)"""


FLAG_ROLES = FLAG_FRAME + roles("lag_7, rain_30d, temp_7d, demand")
FULL_ROLES = FLAG_FRAME + roles(", ".join(c for c in RAW if c != "level"))
NATION_ROLES = NATION_FLAG + ", " + frame("nation_flag_panel") + roles("lag_7, rain_30d, temp_7d, demand")
WEIGHT = "exp(-date_diff('day', date, latest) * ln(2) / 365.0)"


def ols(strategy, source=FLAG_ROLES):
    """CTEs ending in `predictions` of the one-regressor model."""
    if strategy == "baseline":
        model = """models as (select entity, horizon, fold, coalesce(regr_slope(target, lag_7), 0) as slope,
  coalesce(regr_intercept(target, lag_7), avg(target)) as intercept
  from train where strategy = 'baseline' and row_no >= seq_len group by all)"""
    else:
        model = f"""weighted as (select *, {WEIGHT} as w from train
  where strategy = 'walkfwd_expanding' and row_no >= seq_len),
centres as (select entity, horizon, fold, sum(w * lag_7) / sum(w) as mx, sum(w * target) / sum(w) as my
  from weighted group by all),
models as (select entity, horizon, fold,
  sum(w * (lag_7 - mx) * (target - my)) / nullif(sum(w * (lag_7 - mx) * (lag_7 - mx)), 0) as slope,
  any_value(my) - sum(w * (lag_7 - mx) * (target - my)) / nullif(sum(w * (lag_7 - mx) * (lag_7 - mx)), 0)
    * any_value(mx) as intercept
  from weighted join centres using (entity, horizon, fold) group by all)"""
    return f"""{source}, {model},
predictions as (select entity, strategy, 'ols' as model, horizon, date, target as y,
  least(greatest(intercept + slope * lag_7, 0), 100) as yhat
  from test join models using (entity, horizon, fold) where strategy = '{strategy}')"""


METRICS = """means as (select entity, strategy, horizon, avg(y) as ybar from predictions group by all),
errors as (select entity, strategy, model, horizon, count(*) as n, sqrt(avg((y - yhat) * (y - yhat))) as rmse,
  avg(abs(y - yhat)) as mae,
  1 - sum((y - yhat) * (y - yhat)) / nullif(sum((y - ybar) * (y - ybar)), 0) as r2
  from predictions join means using (entity, strategy, horizon) group by all)"""
KEY = "entity, strategy, horizon, fold"
RIDGE_PAIR = f"""{FLAG_ROLES},
bounds as (select {KEY}, min(lag_7) as l1, max(lag_7) as h1, min(rain_30d) as l2, max(rain_30d) as h2,
  min(target) as ly, max(target) as hy from train group by all),
samples as (select {KEY}, target as y, (lag_7 - l1) / (h1 - l1) as s1, (rain_30d - l2) / (h2 - l2) as s2,
  (target - ly) / (hy - ly) as sy, ly, hy, case when strategy = 'baseline' then 1.0 else {WEIGHT} end as w,
  row_no - seq_len + 1 > floor(train_samples * 0.8) as is_val
  from train join bounds using ({KEY}) where row_no >= seq_len),
centres as (select {KEY}, sum(w * s1) / sum(w) as m1, sum(w * s2) / sum(w) as m2, sum(w * sy) / sum(w) as my
  from samples where not is_val group by all),
spreads as (select {KEY}, any_value(m1) as m1, any_value(m2) as m2, any_value(my) as my,
  sum(w * (s1 - m1) * (s1 - m1)) / sum(w) as c11, sum(w * (s1 - m1) * (s2 - m2)) / sum(w) as c12,
  sum(w * (s2 - m2) * (s2 - m2)) / sum(w) as c22, sum(w * (s1 - m1) * (sy - my)) / sum(w) as c1y,
  sum(w * (s2 - m2) * (sy - my)) / sum(w) as c2y
  from samples join centres using ({KEY}) where not is_val group by all),
solved as (select {KEY}, p, m1, m2, my,
  ((c22 + p) * c1y - c12 * c2y) / ((c11 + p) * (c22 + p) - c12 * c12) as b1,
  ((c11 + p) * c2y - c12 * c1y) / ((c11 + p) * (c22 + p) - c12 * c12) as b2
  from spreads, (values (1e-6), (1e-4), (1e-2), (1.0)) t(p)),
judged as (select {KEY}, p, any_value(m1) as m1, any_value(m2) as m2, any_value(my) as my, any_value(b1) as b1,
  any_value(b2) as b2, avg(power((my + b1 * (s1 - m1) + b2 * (s2 - m2)) * (hy - ly) + ly - y, 2)) as mse
  from solved join samples using ({KEY}) where is_val group by {KEY}, p),
chosen as (select * from judged qualify row_number() over (partition by {KEY} order by mse, p) = 1),
predictions as (select entity, strategy, 'ridge' as model, horizon, date, target as y, least(greatest(
    (my + b1 * ((lag_7 - l1) / (h1 - l1) - m1) + b2 * ((rain_30d - l2) / (h2 - l2) - m2)) * (hy - ly) + ly, 0), 100) as yhat
  from test join chosen using ({KEY}) join bounds using ({KEY}))"""
METRIC_COLUMNS = f"entity, strategy, model, horizon, n, {r('rmse', 4)}, {r('mae', 4)}, {r('r2', 4)}"

SERIES_COLUMNS = {f"{f}{SUFFIX}": ("level", f) for f in "ANR"} | {
    f"prcp_{f}": ("rain", f) for f in "ANR"} | {f"tavg_{f}": ("temp", f) for f in "ANR"}
#: Columns of the wide table in the order of the file: level, rain and temperature of one flag after the other.
FLAG_COLUMNS = [c for f in "ANR" for c in (f"{f}{SUFFIX}", f"prcp_{f}", f"tavg_{f}")]
WIDE = "wide as (select date, " + ", ".join(
    f'max(case when entity = \'{f}\' then {m} end) as "{c}"' for c, (m, f) in SERIES_COLUMNS.items()
) + " from flag_panel group by date)"
LONG = "long as (" + " union all ".join(
    f"select date, '{c}' as series, \"{c}\" as value from wide" for c in SERIES_COLUMNS) + ")"
KNOWN = f"""{STATION}, {REGION}, known as (select series, count(value) as n_values from (
  {' union all '.join(f"select concat('{m}_', station) as series, {m} as value from station_panel" for m in ('prcp', 'tavg', 'tmax', 'tmin'))}
  union all select concat(entity, '{SUFFIX}'), level from region_panel
  union all select 'demand', demand from region_panel) group by series)"""

FEATURES = sorted(c for c in RAW if c != "level")
_sequence_value = " + ".join(f"{i + 1} * round({c} * 100)" for i, c in enumerate(FEATURES))


def _sequences(strategy):
    parts = []
    for h, n in HORIZONS:
        over = f"(partition by entity order by date rows between {n - 1} preceding and current row)"
        parts.append(f"select entity, date, {h} as horizon, {n} as seq_len, list(v) over {over} as vs from valued")
    own = ("role = 'train' and row_no >= seq_len or role = 'test' and part_no >= seq_len"
           if strategy == "baseline" else "role = 'test' and row_no >= seq_len")
    return f"""with {FLAG_FRAME}{roles("lag_7, rain_30d, temp_7d, demand")},
valued as (select entity, date, {_sequence_value} as v from frame),
seqs as ({' union all '.join(parts)})
select entity, date, horizon, role, cast(len(vs) as integer) as n_steps, cast(len(vs) * {len(FEATURES)} as integer) as n_values,
  round(list_sum(list_transform(vs, lambda v, i : v * i)), 4) + 0.0 as checksum
from tagged join seqs using (entity, date, horizon, seq_len)
where strategy = '{strategy}' and ({own})"""


def _gram_terms():
    every = ("lag_7", "rain_30d", "temp_7d", "target")
    terms = [(f"s_{c}", c) for c in every]
    terms += [(f"p_{a}_{b}", f"{a} * {b}") for i, a in enumerate(every) for b in every[i:]]
    return " union all ".join(
        f"select entity, horizon, fold, '{n}' as term, "
        f"round(sum(w * {e}) filter (where not is_val) / sum(w) filter (where not is_val), 3) + 0.0 as fit_mean, "
        f"round(avg({e}) filter (where is_val), 3) + 0.0 as val_mean from samples group by all" for n, e in terms)


def _summary():
    cells = ", ".join(
        f"max(case when horizon = {h} then round({m}, {4 if m == 'r2' else 2}) end) as {m}_{h}d"
        for h, _ in HORIZONS for m in ("rmse", "mae", "r2"))
    return f"""with {ols('baseline')}, {METRICS},
counts as (select entity, max(train_rows) filter (where horizon = 30) as train_rows, max(test_rows) as test_rows
  from fold_sizes where strategy = 'baseline' group by all)
select entity, strategy, model, {cells}, any_value(train_rows) as train_rows, any_value(test_rows) as test_rows
from errors left join counts using (entity) group by all"""


_OLS_FEATURES = {
    "level": "level", "lag_7": lag(7), "lag_14": lag(14), "delta_1": f"{lag(7)} - {lag(8)}", "delta_7": f"{lag(7)} - {lag(14)}",
    "rolling_mean_30": mean_before(30), "rolling_mean_180": mean_before(180), "rolling_mean_365": mean_before(365),
    "rolling_std_30": STD}
OLS_JOB = f"""{REGION}, read_levels as (select entity, date,
  case when entity = 'ASIA' and date between date '1998-03-01' and date '1998-03-03' then 130.0 else level end as level
  from region_panel where entity in ('AFRICA', 'ASIA', 'EUROPE', 'MIDDLE EAST')),
levels as (select entity, date, case when level > 100 then null else level end as level from read_levels),
raw_f as (select entity, date, {', '.join(f'{e} as {n}' for n, e in _OLS_FEATURES.items())} from levels),
filled as (select entity, date, {', '.join(f'last_value({n} ignore nulls) over {FILL} as {n}' for n in _OLS_FEATURES)} from raw_f),
ahead as (select *, {', '.join(f'lead(level, {h}) over {W} as target_{h}' for h, _ in HORIZONS)} from filled),
bounds as (select entity, greatest(min(date) filter (where level is not null), date '1996-01-01') as first_day,
  case when entity = 'ASIA' then date '2001-06-30' else date '2001-09-30' end as last_day from levels group by entity),
frame as (select ahead.* from ahead join bounds using (entity) where date between first_day and last_day and
  {' and '.join(f'{n} is not null' for n in [*_OLS_FEATURES, 'target_7', 'target_14', 'target_30'])}),
numbered as (select *, row_number() over {W} as row_no, max(date) over (partition by entity) as last_date,
  row_number() over (partition by entity, date >= {SPLIT} order by date) as part_no from frame),
wanted as (select * from (values ('ASIA', 7, 10), ('ASIA', 14, 20), ('ASIA', 30, 30), ('EUROPE', 7, 30), ('EUROPE', 14, 60),
  ('EUROPE', 30, 90), ('MIDDLE EAST', 7, 15), ('MIDDLE EAST', 14, 45), ('AFRICA', 7, 20), ('AFRICA', 14, 25),
  ('AFRICA', 30, 40)) t(entity, horizon, seq_len)),
h as (select numbered.*, horizon, seq_len, case horizon when 7 then target_7 when 14 then target_14 else target_30 end as target
  from numbered join wanted using (entity)),
starts as (select range as fold, cast({SPLIT} + to_months(cast(6 * range as integer)) as date) as test_start,
  cast({SPLIT} + to_months(cast(6 * range + 6 as integer)) as date) as test_end from range(0, 40)),
pairs as (select h.*, 'baseline' as strategy, 0 as fold,
    case when date + horizon < {SPLIT} then 'train' when date >= {SPLIT} then 'test' end as role from h where entity <> 'AFRICA'
  union all select h.*, 'walkfwd_expanding', fold, case when date < test_start then 'train' when date < test_end then 'test' end
  from h join starts on test_start < last_date where entity = 'AFRICA'),
sizes as (select entity, horizon, fold, count(*) filter (where role = 'train') as train_rows,
  max(date) filter (where role = 'train') as latest from pairs group by all having count(*) filter (where role = 'test') > 0),
used as (select pairs.*, latest from pairs join sizes using (entity, horizon, fold)
  where role is not null and train_rows >= seq_len + 10 and (strategy = 'baseline' or train_rows > 60)),
weighted as (select *, case when strategy = 'baseline' then 1.0 else exp(-date_diff('day', date, latest) * ln(2) / 180.0) end as w
  from used where role = 'train' and row_no >= seq_len),
centres as (select entity, horizon, fold, sum(w * lag_7) / sum(w) as mx, sum(w * target) / sum(w) as my from weighted group by all),
models as (select entity, horizon, fold, any_value(mx) as mx, any_value(my) as my,
  sum(w * (lag_7 - mx) * (target - my)) / nullif(sum(w * (lag_7 - mx) * (lag_7 - mx)), 0) as slope
  from weighted join centres using (entity, horizon, fold) group by all),
predictions as (select entity, strategy, 'ols' as model, horizon, date, target as y,
  least(greatest(my + slope * (lag_7 - mx), 0), 100) as yhat from used join models using (entity, horizon, fold)
  where role = 'test' and case when strategy = 'baseline' then part_no else row_no end >= seq_len)"""


_kept = "entity, date"
SQL = {
    "config_ols_report": f"with {OLS_JOB}, {METRICS} select {METRIC_COLUMNS} from errors",
    "run_warnings": f"""with {OLS_JOB}, {METRICS},
cut as (select entity, count(*) filter (where date < first_day) as early, count(*) filter (where date > last_day) as late
  from levels join bounds using (entity) group by entity),
gone as (select entity, horizon from (select distinct entity from levels), (values (7), (14), (30)) t(horizon)
  except select entity, horizon from errors)
select 'levels above the limit' as kind, entity, cast(count(*) as varchar) as detail from read_levels where level > 100
  group by entity
union all select 'unknown strategy, baseline used', 'ASIA', 'rolling'
union all select 'production series absent', 'ASIA', 'absent_series'
union all select 'entity without levels', 'NOWHERE', ''
union all select 'rows before the start', entity, cast(early as varchar) from cut where early > 0
union all select 'rows after the end', entity, cast(late as varchar) from cut where late > 0
union all select 'no model for a horizon', entity, cast(horizon as varchar) from gone""",
    "gbt_prediction_keys": f"""with {FLAG_ROLES} select entity, strategy, horizon, cast(fold as integer) as fold,
  count(*) as n_rows, count(distinct date) as n_dates from test group by all""",
    "prediction_sink": f"""with {ols('baseline')} select entity, strategy, horizon, date, round(y, 4) as y, round(yhat, 4) as yhat
from predictions""",
    "summary_sink": _summary(),
    "slice_ols_report": f"""with {FLAG}, f as (select entity, date, {lag(7)} as lag_7, {lag(7)} - {lag(8)} as delta_1,
  {days('sum', 'rain', 7)} as rain_7d, {mean_before(30)} as rolling_mean_30, lead(level, 7) over {W} as target
  from flag_panel),
rows_ as (select * from f where lag_7 is not null and delta_1 is not null and rain_7d is not null
  and rolling_mean_30 is not null and target is not null),
models as (select entity, count(*) as train_rows, regr_slope(target, lag_7) as slope,
  regr_intercept(target, lag_7) as intercept from rows_ where date + 7 < {SPLIT} group by entity),
p as (select entity, train_rows, target as y, least(greatest(intercept + slope * lag_7, 0), 100) as yhat
  from rows_ join models using (entity) where date >= {SPLIT} and train_rows >= 11),
m as (select entity, avg(y) as ybar from p group by entity)
select entity, any_value(train_rows) as train_rows, count(*) as test_rows,
  round(sqrt(avg((y - yhat) * (y - yhat))), 4) as rmse, round(avg(abs(y - yhat)), 4) as mae,
  round(1 - sum((y - yhat) * (y - yhat)) / nullif(sum((y - ybar) * (y - ybar)), 0), 4) + 0.0 as r2
from p join m using (entity) group by entity""",
    "csv_scan": f"""with {FLAG}, {WIDE} select date, {', '.join(
        f'round("{c}", 6) + 0.0 as "{c}"' for c in SERIES_COLUMNS)} from wide""",
    "rejected_rows": f"""with {FLAG}, {WIDE}, n as (
  select row_number() over (order by date) + 1 as line, day(date) as d, strftime(date, '%d.%m.%Y') as text from wide)
select line, 'Date' as "column", 'on ' || text as text from n where d = 17
union all select line, null, text from n where d = 23
union all select line, '{FLAG_COLUMNS[0]}', '12,5x' from n where d = 13
union all select line, '{FLAG_COLUMNS[4]}', 'none' from n where d = 19
union all select line, '{FLAG_COLUMNS[8]}', '--' from n where d in (13, 19)
union all select count(*), 'rows kept', null from n where d not in (13, 17, 19, 23)""",
    "date_parse": """with t as (select o_orderkey, case o_orderkey % 4
    when 0 then strftime(o_orderdate, '%d.%m.%Y') when 1 then strftime(o_orderdate, '%-d/%-m/%Y')
    when 2 then strftime(o_orderdate, '%Y-%m-%d') else concat('on ', strftime(o_orderdate, '%Y-%m-%d')) end as date_text
  from orders)
select o_orderkey, date_text,
  cast(try_strptime(date_text, ['%d.%m.%Y', '%d/%m/%Y', '%Y-%m-%d']) as date) as parsed from t""",
    "config_scan": f"with {CONFIG} select {CONFIG_TEXT} from config",
    "config_file_scan": f"with {CONFIG} select {CONFIG_TEXT} from config",
    "unpivot_long": f"with {FLAG}, {WIDE}, {LONG} select date, series, {r('value')} from long",
    "pivot_wide": f"with {STATION} select date, " + ", ".join(
        f"max(case when station = 'NATION_{i}' then prcp end) as \"prcp_NATION_{i}\"" for i in range(25)
    ) + " from station_panel group by date",
    "series_by_name": f"""with {FLAG}, {WIDE}, {LONG}, n as (select series, count(value) as n_values from long group by 1)
select series, n_values, case when contains(series, '{SUFFIX}') then 'level' when starts_with(series, 'prcp_') then 'prcp'
  when starts_with(series, 'evap_') then 'evap' end as role from n
where contains(series, '{SUFFIX}') or starts_with(series, 'prcp_') or starts_with(series, 'evap_')""",
    "drop_empty_series": f"with {DIRTY}, long as (" + " union all ".join(
        f"select entity, '{c}' as series, {c} as value from dirty_panel"
        for c in ("level", "rain", "temp", "demand", "empty_col")
    ) + ") select entity, series, count(*) as n_rows, count(value) as n_values from long group by 1, 2 having count(value) > 0",
    "missing_flags": f"""with {DIRTY} select entity, date, cast(rain is null as integer) as rain_missing,
  cast(temp is null as integer) as temp_missing from dirty_panel""",
    "fill_zero": f"""with {DIRTY} select entity, date, cast(rain is null as integer) as rain_missing,
  coalesce(rain, 0.0) as rain from dirty_panel""",
    "cap_level": f"""with {DIRTY} select entity, date, round(case when level <= 100 then level end, 6) as level
  from dirty_panel""",
    "bad_level_count": f"""with {DIRTY} select entity, count(*) as bad_rows from dirty_panel where level > 100
  group by entity""",
    "profile": f"""with {DIRTY} select count(*) as n_rows, cast(7 as bigint) as n_columns, min(date) as first_date,
  max(date) as last_date from dirty_panel""",
    "rain_range_sums": f"with {SUPPLIER} select {_kept}, " + ", ".join(
        r(days("sum", "rain", k), 2, f"rain_{k}d") for k in (7, 30, 90)) + " from supplier_panel",
    "temp_range_mean": f"with {DIRTY} select {_kept}, {r(days('avg', 'temp', 7), 6, 'temp_7d')} from dirty_panel",
    "lags": f"with {SUPPLIER} select {_kept}, " + ", ".join(
        r(lag(k), 6, f"lag_{k}") for k in LAGS) + " from supplier_panel",
    "deltas": f"with {SUPPLIER} select {_kept}, " + ", ".join(
        r(RAW[f"delta_{k}"], 6, f"delta_{k}") for k in (1, 7, 30)) + " from supplier_panel",
    "rolling_means": f"with {SUPPLIER} select {_kept}, " + ", ".join(
        r(RAW[c], 6, c) for c in ("rolling_mean_30", "rolling_mean_180", "rolling_mean_365", "trend_direction")
    ) + " from supplier_panel",
    "rolling_std": f"with {SUPPLIER} select {_kept}, {r(STD, 6, 'rolling_std_30')} from supplier_panel",
    "rain_x_level": f"with {SUPPLIER} select {_kept}, {r(RAW['rain_x_level'], 4, 'rain_x_level')} from supplier_panel",
    "demand_lag": f"with {SUPPLIER} select {_kept}, {r(RAW['demand'], 2, 'demand')} from supplier_panel",
    "forward_fill": f"with {CLEAN} select {_kept}, " + ", ".join(
        r(f"last_value({c} ignore nulls) over {FILL}", 6, c) for c in ("level", "rain", "temp")) + " from clean_panel",
    "targets": f"""with {CLEAN}, filled as (select entity, date, last_value(level ignore nulls) over {FILL} as level
  from clean_panel) select {_kept}, """ + ", ".join(
        r(f"lead(level, {h}) over {W}", 6, f"target_{h}") for h, _ in HORIZONS) + " from filled",
    "seasonal": f"with {SUPPLIER} select {_kept}, " + ", ".join(
        r(e, 6, n) for n, e in SEASONAL.items()) + " from supplier_panel",
    "feature_frame": f"with {FLAG_FRAME} select {FRAME_COLUMNS} from frame",
    "feature_frame_segments": f"with {FLAG_FRAME} select {FRAME_COLUMNS} from frame",
    "feature_frame_dirty": f"""with {CLEAN}, zero_panel as (select entity, date, level, coalesce(rain, 0.0) as rain, temp,
  demand from clean_panel), {frame('zero_panel')} select {FRAME_COLUMNS} from frame""",
    "feature_frame_supplier": f"with {SUPPLIER}, {frame('supplier_panel')} select {FRAME_COLUMNS} from frame",
    "config_projection": f"""with {SETTINGS}, {KNOWN}, wanted as (
  select entity, 0 as position, concat(entity, '{SUFFIX}') as series from settings
  union all select entity, cast(i as integer), prod_cols[i] from settings, range(1, 3) t(i)
  union all select entity, cast(2 + 8 * (s - 1) + m as integer), concat({list(WEATHER)}[m], '_', weather_stations[s])
  from settings, range(1, 100) t(s), range(1, 9) u(m) where s <= len(weather_stations))
select entity, position, series, n_values from wanted join known using (series)""",
    "missing_config_columns": f"""with {SETTINGS}, {KNOWN}, wanted as (
  select entity, unnest(prod_cols) as series from settings)
select entity, series from wanted where series not in (select series from known)""",
    "station_features": f"""with {SETTINGS}, {STATION}, {REGION},
feats as (select station, date, prcp, {', '.join(
        f"{days('sum', 'prcp', k, 'station')} as rain_{k}d" for k in (7, 30, 90))},
  {days('avg', 'tavg', 7, 'station')} as temp_7d from station_panel),
lagged as (select entity, date, {lag(7)} as l from region_panel),
used as (select entity, unnest(weather_stations) as station, generate_subscripts(weather_stations, 1) - 1 as position
  from settings),
joined as (select entity, cast(position as integer) as position, station, date, rain_7d, rain_30d, rain_90d, temp_7d, prcp * l as rain_x_level
  from lagged join used using (entity) left join feats using (station, date))
select entity, position, station, date, {', '.join(
        r(f"last_value({c} ignore nulls) over (partition by entity, station order by date rows unbounded preceding)",
          4 if c == "rain_x_level" else 6, c)
        for c in ("rain_7d", "rain_30d", "rain_90d", "temp_7d", "rain_x_level"))} from joined""",
    "entity_subset": f"""with {REGION}, wanted as (select entity, position from
  (values ('EUROPE', 0), ('ATLANTIS', 1), ('AFRICA', 2), ('ASIA', 3)) t(entity, position))
select entity, position, count(*) as n_dates from region_panel join wanted using (entity) group by 1, 2""",
    "config_defaults": f"with {SETTINGS} select {CONFIG_TEXT}, requested_strategy from settings",
    "horizon_config": f"""with {HORIZON_CONFIG} select entity, horizon, seq_len,
  array_to_string(lag_days, ',') as lag_days from horizon_config""",
    "lag_columns": f"""with {HORIZON_CONFIG}, one as (select distinct entity, unnest(lag_days) as k from horizon_config)
select entity, string_agg(concat('lag_', cast(k as varchar)), ',' order by k) as lag_columns from one group by entity""",
    "natural_start": f"""with {SUPPLIER} select entity, min(date) as natural_start from supplier_panel
where level <> 0 group by entity""",
    "date_bounds": f"""with {SUPPLIER}, b as (select entity, min(date) filter (where level <> 0) as natural_start
  from supplier_panel group by entity),
c as (select entity, natural_start, greatest(natural_start, date '1996-01-01') as start_date,
  case when entity = 'S1' then date '2000-06-30' else date '2001-06-30' end as end_date
  from b where natural_start is not null)
select entity, natural_start, start_date, end_date, count(*) filter (where date between start_date and end_date) as n_rows
from c join supplier_panel using (entity) group by all""",
    "date_bounds_table": f"""with {SUPPLIER}, b as (select entity, min(date) filter (where level <> 0) as natural_start
  from supplier_panel group by entity),
e as (select 'S' || l_suppkey as entity, true as own, cast(max(l_shipdate) filter (where l_orderkey % 2 = 0) as date) - 200 as end_date
  from lineitem where l_suppkey % 3 > 0 group by l_suppkey)
select entity, natural_start, greatest(natural_start, date '1996-01-01') as start_date,
  case when own then end_date else date '1998-01-31' end as end_date
from b left join e using (entity) where natural_start is not null""",
    "baseline_split": f"""with {FLAG_ROLES} select entity, date, horizon, cast(date + horizon as date) as target_date, role
from tagged where strategy = 'baseline'""",
    "folds": f"""with {REGION}, starts as (select range as fold,
  cast({SPLIT} + to_months(cast(6 * range as integer)) as date) as test_start,
  cast({SPLIT} + to_months(cast(6 * range + 6 as integer)) as date) as test_end from range(0, 40)),
l as (select entity, max(date) as last_date from region_panel group by entity),
p as (select entity, fold, test_start, test_end, count(*) filter (where date < test_start) as train_rows,
  count(*) filter (where date >= test_start and date < test_end) as test_rows
  from region_panel join l using (entity) join starts on test_start < last_date group by all)
select entity, cast(fold as integer) as fold, test_start, test_end, train_rows, test_rows from p
where train_rows > 60 and test_rows > 0""",
    "fold_rows": f"""with {FLAG_ROLES} select entity, strategy, horizon, seq_len, cast(fold as integer) as fold,
  train_rows, train_samples, test_rows, usable from fold_sizes""",
    "strategy_union": f"""with {FLAG_ROLES} select entity, date, strategy, horizon, cast(fold as integer) as test_fold
from tagged where role = 'test' and case when strategy = 'baseline' then part_no else row_no end >= seq_len""",
    "sample_weights": f"""with {FLAG_ROLES}, raw as (select entity, horizon, cast(fold as integer) as fold, date, {WEIGHT} as w
  from train where strategy = 'walkfwd_expanding' and row_no >= seq_len)
select entity, horizon, fold, date, round(w / avg(w) over (partition by entity, horizon, fold), 6) as weight from raw""",
    "validation_tail": f"""with {FLAG_ROLES}, s as (select entity, strategy, horizon, cast(fold as integer) as fold, date,
  row_number() over (partition by entity, strategy, horizon, fold order by date) as sample_no,
  count(*) over (partition by entity, strategy, horizon, fold) as n from train where row_no >= seq_len)
select entity, strategy, horizon, fold, date, cast(sample_no as integer) as sample_no,
  sample_no > floor(n * 0.8) as is_val from s""",
    "scale_bounds": f"with {FULL_ROLES} " + " union all ".join(
        f"""select entity, strategy, horizon, cast(fold as integer) as fold, '{c}' as feature,
  round(min({c}), 4) + 0.0 as lo, round(max({c}), 4) + 0.0 as hi
  from tagged join fold_sizes using (entity, strategy, horizon, fold) where role = 'train' group by 1, 2, 3, 4"""
        for c in [*FEATURES, "target"]),
    "scaled_features": f"with {FULL_ROLES}, b as (select entity, strategy, horizon, fold, " + ", ".join(
        f"min({c}) as lo_{c}, max({c}) as hi_{c}" for c in [*FEATURES, "target"]
    ) + """ from tagged where role = 'train' group by 1, 2, 3, 4)
select entity, strategy, horizon, date, """ + ", ".join(
        r(f"({c} - lo_{c}) / coalesce(nullif(hi_{c} - lo_{c}, 0), 1)", 6, f"scaled_{c}")
        for c in [*FEATURES, "target"]
    ) + """, round(target, 6) as restored_target
from tagged join b using (entity, strategy, horizon, fold) where role = 'test'""",
    "sequences_baseline": _sequences("baseline"),
    "sequences_walkforward": _sequences("walkfwd_expanding"),
    "sequence_store": _sequences("walkfwd_expanding"),
    "metrics_baseline": f"with {ols('baseline')}, {METRICS} select {METRIC_COLUMNS} from errors",
    "metrics_walkforward": f"with {ols('walkfwd_expanding')}, {METRICS} select {METRIC_COLUMNS} from errors",
    "metrics_nation_baseline": f"with {ols('baseline', NATION_ROLES)}, {METRICS} select {METRIC_COLUMNS} from errors",
    "metrics_nation_walkforward":
        f"with {ols('walkfwd_expanding', NATION_ROLES)}, {METRICS} select {METRIC_COLUMNS} from errors",
    "summary_pivot": _summary(),
    "missing_horizons": f"""with {SUPPLIER}, {frame('supplier_panel')}{roles('lag_7, rain_30d, temp_7d, demand')},
expected as (select distinct entity, horizon from supplier_panel, (values (7), (14), (30)) t(horizon))
select entity, horizon from expected
except select entity, horizon from fold_sizes where usable and strategy = 'baseline'""",
    "residual_report": f"""with {ols('baseline')} select entity, strategy, model, horizon, date,
  cast(date + horizon as date) as target_date, round(y, 4) as y, round(yhat, 4) as yhat, {r('y - yhat', 4, 'residual')},
  y - yhat < 0 as is_negative, round(least(y, yhat), 4) as band_low, round(greatest(y, yhat), 4) as band_high
from predictions""",
    "weighted_ols": f"""with {ols('walkfwd_expanding')} select entity, horizon, cast(m.fold as integer) as fold, train_rows,
  train_samples, test_rows, {r('slope', 5)}, {r('intercept', 5)}
from models m join (select * from fold_sizes where strategy = 'walkfwd_expanding') f using (entity, horizon, fold)""",
    "window_slopes": f"""with {FLAG_FRAME}, numbered as (select *, row_number() over (partition by entity order by date) as n from frame),
long as (select entity, date, n, c.feature, c.x from (select entity, date, n, unnest([
  {', '.join(f"{{'feature': '{c}', 'x': cast({c} as double)}}" for c in ('level', 'lag_7', 'delta_1', 'rain_30d', 'temp_7d', 'rolling_std_30'))}]) as c
  from numbered)),
w as (select entity, year(date) as year, feature, {', '.join(
    f"case when n >= {k} then {f} over (partition by entity, feature order by date rows {k - 1} preceding) end as {name}_{k}"
    for name, f in (('mean', 'avg(x)'), ('slope', 'regr_slope(x, n)')) for k in (30, 90))} from long)
select entity, cast(year as integer) as year, feature, count(mean_30) as n_30, count(mean_90) as n_90, {', '.join(
    f'round(avg({c}), 5) + 0.0 as {c}, round(stddev_samp({c}), 5) as sd_{c}' for c in ('mean_30', 'mean_90', 'slope_30', 'slope_90'))}
from w group by entity, year, feature""",
    "ridge_statistics": f"""with {FLAG_ROLES}, samples as (
  select entity, horizon, cast(fold as integer) as fold, lag_7, rain_30d, temp_7d, target, {WEIGHT} as w,
    row_no - seq_len + 1 > floor(train_samples * 0.8) as is_val
  from train where strategy = 'walkfwd_expanding' and row_no >= seq_len)
{_gram_terms()}""",
    "ridge_pair_report": f"with {RIDGE_PAIR}, {METRICS} select {METRIC_COLUMNS} from errors",
    "context_rows": f"""with {FLAG_ROLES}, u as (select * from fold_sizes where strategy = 'walkfwd_expanding' and usable)
select entity, horizon, cast(fold as integer) as fold, date, role = 'train' as is_context
from tagged t join u using (entity, strategy, horizon, fold)
where role = 'test' or row_no > u.train_rows - (t.seq_len - 1)""",
    "time_interpolate": f"""with {CLEAN}, n as (select entity, date, level,
  last_value(level ignore nulls) over {FILL} as v0,
  last_value(case when level is not null then date end ignore nulls) over {FILL} as d0,
  first_value(level ignore nulls) over (partition by entity order by date rows between current row and unbounded following) as v1,
  first_value(case when level is not null then date end ignore nulls)
    over (partition by entity order by date rows between current row and unbounded following) as d1 from clean_panel)
select entity, date, round(case when level is not null then level when v1 is null then v0
  else v0 + (v1 - v0) * date_diff('day', d0, date) / date_diff('day', d0, d1) end, 6) + 0.0 as level from n""",
    "test_fill": f"""with {CLEAN}, f as (select entity, date, last_value(level ignore nulls) over {FILL} as level
  from clean_panel where date >= date '1997-05-05') select entity, date, round(level, 6) as level from f
where level is not null""",
}
