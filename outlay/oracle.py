"""The registered queries as ANSI SQL over the same tables, for DuckDB."""

from __future__ import annotations

AGREEMENTS = """
typed as (
    select
        o_orderkey as id_convenio,
        'P-' || cast(o_orderkey as varchar) as numero_processo,
        o_orderstatus as situacao,
        cast(o_orderdate as date) as data_publicacao,
        cast(o_orderdate as date) as data_inicio_vigencia,
        cast(o_orderdate as date) + 365 as data_final_vigencia,
        cast(o_totalprice as decimal(18, 2)) as valor,
        cast(case when o_orderstatus = 'F' then cast(o_totalprice as decimal(18, 2)) else 0 end as decimal(18, 2))
            as valor_liberado,
        cast(0 as decimal(18, 2)) as valor_contrapartida,
        cast(c_custkey as varchar) as municipio_codigo_ibge,
        c_name as municipio_nome,
        cast(r_regionkey as varchar) as municipio_codigo_regiao,
        r_name as municipio_nome_regiao,
        'N' || cast(n_nationkey as varchar) as municipio_uf_sigla,
        n_name as municipio_uf_nome,
        o_orderpriority as orgao_codigo_siafi,
        o_orderpriority as orgao_nome,
        '' as orgao_sigla,
        o_orderpriority as orgao_superior_codigo,
        o_orderpriority as orgao_superior_nome,
        case when o_orderpriority = '5-LOW' then '' else substring(o_orderpriority, 1, 1) end as orgao_superior_sigla,
        o_orderdate as carregado_em
    from orders
    left join customer on o_custkey = c_custkey
    left join nation on c_nationkey = n_nationkey
    left join region on n_regionkey = r_regionkey
),
versions as (
    select *, row_number() over (
        partition by id_convenio
        order by carregado_em desc nulls last, numero_processo nulls last, situacao nulls last,
            valor nulls last, valor_liberado nulls last, municipio_codigo_ibge nulls last, municipio_nome nulls last,
            municipio_codigo_regiao nulls last, municipio_uf_sigla nulls last, orgao_superior_codigo nulls last
    ) as versao
    from typed
),
stg as (
    select * from versions
    where versao = 1 and municipio_codigo_ibge is not null and orgao_superior_codigo is not null
      and data_publicacao >= date '1998-08-01'
)"""

GEOGRAPHY = """
geo_rows as (
    select distinct municipio_codigo_ibge as codigo_ibge, municipio_nome as nome_municipio,
        municipio_uf_sigla as uf_sigla, municipio_uf_nome as uf_nome,
        municipio_codigo_regiao as codigo_regiao, municipio_nome_regiao as nome_regiao
    from stg
),
geo as (
    select md5(codigo_ibge) as sk_municipio, codigo_ibge, nome_municipio, uf_sigla, uf_nome, codigo_regiao, nome_regiao
    from (
        select *, row_number() over (
            partition by codigo_ibge order by nome_municipio nulls last, uf_sigla nulls last, codigo_regiao nulls last
        ) as linha
        from geo_rows
    ) ranked
    where linha = 1
)"""

AGENCY = """
agency_rows as (
    select distinct orgao_superior_codigo as codigo_orgao_superior, orgao_superior_nome as nome_orgao_superior,
        orgao_superior_sigla as sigla_orgao_superior
    from stg
),
agency as (
    select md5(codigo_orgao_superior) as sk_orgao_superior, codigo_orgao_superior, nome_orgao_superior,
        sigla_orgao_superior
    from (
        select *, row_number() over (
            partition by codigo_orgao_superior order by nome_orgao_superior nulls last, sigla_orgao_superior nulls last
        ) as linha
        from agency_rows
    ) ranked
    where linha = 1
)"""

FACT = """
fct as (
    select id_convenio, numero_processo, situacao, data_publicacao, data_inicio_vigencia, data_final_vigencia,
        cast(date_trunc('month', data_publicacao) as date) as mes_referencia,
        sk_municipio, sk_orgao_superior, valor, valor_liberado, valor_contrapartida
    from stg
    left join geo on stg.municipio_codigo_ibge = geo.codigo_ibge
    left join agency on stg.orgao_superior_codigo = agency.codigo_orgao_superior
)"""

AMENDMENTS = """
items as (
    select *, cast(l_extendedprice as decimal(18, 2)) as price,
        cast(cast(l_extendedprice as decimal(18, 2)) * (1 - cast(l_discount as decimal(4, 2))) as decimal(18, 2))
            as paid
    from lineitem
),
stge as (
    select
        cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as codigo_emenda,
        cast(l_linenumber as varchar) as numero_emenda,
        cast(year(l_shipdate) as int) as ano,
        p_type as tipo_emenda,
        s_name as nome_autor,
        l_linestatus as localidade_gasto,
        l_returnflag as funcao,
        l_linestatus as subfuncao,
        price as valor_empenhado,
        paid as valor_liquidado,
        paid as valor_pago,
        cast(price - paid as decimal(18, 2)) as valor_resto_inscrito,
        cast(case when l_returnflag = 'R' then price else 0 end as decimal(18, 2)) as valor_resto_cancelado,
        cast(0 as decimal(18, 2)) as valor_resto_pago
    from items
    left join supplier on l_suppkey = s_suppkey
    left join part on l_partkey = p_partkey
    where s_name is not null and l_extendedprice is not null
),
author as (
    select distinct md5(nome_autor || '|' || tipo_emenda) as sk_autor_emenda, nome_autor, tipo_emenda,
        tipo_emenda ilike '%standard%' as eh_parlamentar_individual
    from stge
),
election as (
    select distinct ano, ano % 2 = 0 as eh_ano_eleitoral,
        case ano % 4 when 2 then 'Geral' when 0 then 'Municipal' end as tipo_eleicao,
        cast((ano - 3) % 4 + 1 as int) as posicao_mandato_federal
    from stge
),
fcte as (
    select codigo_emenda, numero_emenda, ano, localidade_gasto, funcao, subfuncao, sk_autor_emenda,
        valor_empenhado, valor_liquidado, valor_pago, valor_resto_inscrito, valor_resto_cancelado, valor_resto_pago,
        cast(valor_pago as double) / nullif(cast(valor_empenhado as double), 0) as taxa_execucao
    from stge
    left join author on stge.nome_autor = author.nome_autor and stge.tipo_emenda = author.tipo_emenda
)"""

STAR = f"with {AGREEMENTS},{GEOGRAPHY},{AGENCY},{FACT}"
STAR_E = f"with {AMENDMENTS}"

_STG_COLUMNS = """id_convenio, numero_processo, situacao, data_publicacao, data_inicio_vigencia, data_final_vigencia,
    valor, valor_liberado, valor_contrapartida, municipio_codigo_ibge, municipio_nome, municipio_codigo_regiao,
    municipio_nome_regiao, municipio_uf_sigla, municipio_uf_nome, orgao_codigo_siafi, orgao_nome, orgao_sigla,
    orgao_superior_codigo, orgao_superior_nome, orgao_superior_sigla"""

_SUM = "cast(sum({0}) as decimal(38, 2))"


def _sum(column: str) -> str:
    return _SUM.format(column)


def _kpis(where: str) -> str:
    return f"""{STAR},
chosen as (select * from fct where {where}),
by_agency as (
    select nome_orgao_superior as nome, sum(valor) as valor
    from chosen join agency on chosen.sk_orgao_superior = agency.sk_orgao_superior
    group by nome_orgao_superior order by valor desc nulls last, nome limit 1
),
by_month as (
    select mes_referencia, sum(valor) as valor from chosen
    group by mes_referencia order by valor desc nulls last, mes_referencia limit 1
)
select {_sum("valor")} as total_valor, {_sum("valor_liberado")} as total_valor_liberado,
    count(*) as numero_convenios, count(distinct sk_municipio) as numero_municipios,
    count(distinct sk_orgao_superior) as numero_orgaos,
    min(data_publicacao) as periodo_inicio, max(data_publicacao) as periodo_fim,
    (select nome from by_agency) as orgao_maior_gasto_nome,
    (select cast(valor as decimal(38, 2)) from by_agency) as orgao_maior_gasto_valor,
    (select strftime(mes_referencia, '%Y-%m') from by_month) as mes_pico_mes,
    (select cast(valor as decimal(38, 2)) from by_month) as mes_pico_valor
from chosen"""


_RATIO = "cast(sum(valor_pago) as double) / nullif(cast(sum(valor_empenhado) as double), 0)"
_AMENDMENT_SUMS = ", ".join(
    f"{_sum(name)} as {name}" for name in ("valor_empenhado", "valor_pago", "valor_resto_cancelado")
)

_AGENCIES = f"""{STAR},
ranking as (
    select codigo_orgao_superior as codigo, nome_orgao_superior as nome, sigla_orgao_superior as sigla,
        {_sum("valor")} as valor_total, count(*) as numero_convenios
    from fct join agency on fct.sk_orgao_superior = agency.sk_orgao_superior
    group by codigo_orgao_superior, nome_orgao_superior, sigla_orgao_superior
)"""

_PLACES = f"""{STAR},
places as (
    select codigo_ibge, nome_municipio as nome, uf_sigla, uf_nome, nome_regiao as regiao,
        {_sum("valor")} as valor_total, count(*) as numero_convenios
    from fct join geo on fct.sk_municipio = geo.sk_municipio
    group by codigo_ibge, nome_municipio, uf_sigla, uf_nome, nome_regiao
)"""

_AUTHORS = f"""{STAR_E},
authors as (
    select nome_autor as nome, tipo_emenda, eh_parlamentar_individual as individual,
        {_AMENDMENT_SUMS}, {_RATIO} as taxa_execucao, count(*) as numero_emendas
    from fcte join author on fcte.sk_autor_emenda = author.sk_autor_emenda
    group by nome_autor, tipo_emenda, eh_parlamentar_individual
)"""

_YEARS = f"""{STAR_E},
years as (
    select election.ano, eh_ano_eleitoral, coalesce(tipo_eleicao, 'Sem eleição') as tipo_eleicao,
        posicao_mandato_federal, {_sum("valor_empenhado")} as valor_empenhado, {_sum("valor_pago")} as valor_pago,
        count(*) as numero_emendas
    from fcte join election on fcte.ano = election.ano
    group by election.ano, eh_ano_eleitoral, tipo_eleicao, posicao_mandato_federal
)"""

_VERSIONS = """
with ranked as (
    select l_orderkey, l_linenumber, cast(l_shipdate as date) as l_shipdate, l_partkey, l_suppkey, l_returnflag,
        row_number() over (
            partition by l_orderkey, l_linenumber
            order by l_shipdate desc nulls last, l_partkey desc nulls last, l_suppkey desc nulls last,
                l_returnflag nulls last
        ) as versao
    from lineitem
)
select l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_returnflag from ranked where versao = 1"""

# 28-day windows from the first event day on.
_EVENTS = """
with days as (select *, cast(ts as date) as dia from events),
bounds as (select min(dia) as inicio, max(dia) as fim from days),
placed as (
    select days.*,
        inicio + cast(28 * ((dia - inicio) // 28) as int) as janela_inicio,
        least(inicio + cast(28 * ((dia - inicio) // 28) + 27 as int), fim) as janela_fim,
        inicio, fim
    from days, bounds
)"""


def _money_text(amount: str) -> str:
    return f"translate(format('{{:,.2f}}', {amount}), ',.', '.,')"


def _reais(value: str) -> str:
    def scaled(divisor: str, suffix: str) -> str:
        return f"'R$ ' || translate(format('{{:,.1f}}', {value} / {divisor}), ',.', '.,') || ' {suffix}'"

    return f"""case when {value} is null then '—'
        when abs({value}) >= 1e9 then {scaled('1e9', 'bi')}
        when abs({value}) >= 1e6 then {scaled('1e6', 'mi')}
        when abs({value}) >= 1e3 then {scaled('1e3', 'mil')}
        else 'R$ ' || translate(format('{{:,.0f}}', {value}), ',.', '.,') end"""


def _compact(value: str) -> str:
    size = f"abs({value})"

    def shown(power: int) -> str:
        number = f"cast(round({size}, {1 - power}) as double) / 1e{power}"
        return f"replace(replace(format('{{:.1f}}', {number}) || '#', '.0#', ''), '#', '')"

    text = f"""case when round({size}, 1) < 1000 then {shown(0)}
        when round({size}, -2) < 1000000 then {shown(3)} || chr(160) || 'mil'
        when round({size}, -5) < 1000000000 then {shown(6)} || chr(160) || 'mi'
        else {shown(9)} || chr(160) || 'bi' end"""
    return f"(case when {value} < 0 then '-' else '' end) || 'R$' || chr(160) || replace({text}, '.', ',')"


_MONTHS = (
    "['janeiro', 'fevereiro', 'março', 'abril', 'maio', 'junho', "
    "'julho', 'agosto', 'setembro', 'outubro', 'novembro', 'dezembro']"
)

def _unique(table: str, column: str, rows: str) -> str:
    return (
        f"select 'unique_{table}_{column}' as test, (select count(*) from (select {column} from {rows} "
        f"where {column} is not null group by {column} having count(*) > 1) x) as failures"
    )


def _where(kind: str, table: str, column: str, rows: str) -> str:
    condition = f"{column} is null" if kind == "not_null" else f"{column} < 0"
    return f"select '{kind}_{table}_{column}' as test, (select count(*) from {rows} where {condition}) as failures"


def _accepted(table: str, column: str, rows: str, values: str) -> str:
    return (
        f"select 'accepted_values_{table}_{column}' as test, (select count(distinct {column}) from {rows} "
        f"where {column} not in ({values})) as failures"
    )


_MART_ROWS = {
    "dim_municipio": "geo",
    "dim_orgao_superior": "agency",
    "dim_autor_emenda": "author",
    "dim_ano_eleitoral": "election",
    "fct_convenios": "fct",
    "fct_emendas": "fcte",
}


def _contract_sql() -> str:
    checks = (
        ("unique", "dim_municipio", "sk_municipio"), ("not_null", "dim_municipio", "sk_municipio"),
        ("unique", "dim_municipio", "codigo_ibge"), ("not_null", "dim_municipio", "codigo_ibge"),
        ("unique", "dim_orgao_superior", "sk_orgao_superior"), ("not_null", "dim_orgao_superior", "sk_orgao_superior"),
        ("unique", "dim_orgao_superior", "codigo_orgao_superior"),
        ("not_null", "dim_orgao_superior", "codigo_orgao_superior"),
        ("not_null", "fct_convenios", "id_convenio"), ("not_null", "fct_convenios", "sk_municipio"),
        ("not_null", "fct_convenios", "sk_orgao_superior"), ("not_null", "fct_convenios", "valor"),
        ("non_negative", "fct_convenios", "valor"),
        ("unique", "dim_autor_emenda", "sk_autor_emenda"), ("not_null", "dim_autor_emenda", "sk_autor_emenda"),
        ("unique", "dim_ano_eleitoral", "ano"), ("not_null", "dim_ano_eleitoral", "ano"),
        ("accepted_values", "dim_ano_eleitoral", "tipo_eleicao"),
        ("not_null", "fct_emendas", "codigo_emenda"), ("not_null", "fct_emendas", "sk_autor_emenda"),
        ("not_null", "fct_emendas", "valor_empenhado"), ("non_negative", "fct_emendas", "valor_empenhado"),
    )
    parts = []
    for kind, table, column in checks:
        rows = _MART_ROWS[table]
        if kind == "unique":
            parts.append(_unique(table, column, rows))
        elif kind == "accepted_values":
            parts.append(_accepted(table, column, rows, "'Geral', 'Municipal'"))
        else:
            parts.append(_where(kind, table, column, rows))
    return f"{STAR},{AMENDMENTS}\n" + "\nunion all ".join(parts)


_YEAR_TOTALS = """
with items as (
    select cast(year(l_shipdate) as int) as ano_snapshot, cast(l_extendedprice as decimal(18, 2)) as price from lineitem
)
select ano_snapshot, count(*) as registros, cast(sum({value}) as decimal(38, 2)) as valor
from items group by ano_snapshot"""

def _full(value: str) -> str:
    digits = f"translate(format('{{:,.0f}}', cast(round(abs(coalesce({value}, 0)), 0) as double)), ',', '.')"
    return f"(case when {value} < 0 then '-' else '' end) || 'R$' || chr(160) || {digits}"


def _thousands(value: str) -> str:
    return f"translate(format('{{:,}}', {value}), ',', '.')"


def _percent(value: str) -> str:
    return (
        f"case when {value} is null then '—' else cast(cast(round(round({value}, 2) * 100) as int) as varchar) "
        "|| '%' end"
    )


def _month_name(label: str) -> str:
    return f"{_MONTHS}[cast(substring({label}, 6, 2) as int)] || ' de ' || substring({label}, 1, 4)"


def _kpi_texts(where: str) -> str:
    return f"""with k as ({_kpis(where)})
select {_compact("coalesce(total_valor, 0)")} as total, {_full("total_valor")} as total_integral,
    {_compact("coalesce(total_valor_liberado, 0)")} as liberado,
    cast(cast(round(coalesce(coalesce(cast(total_valor_liberado as double), 0) / nullif(cast(total_valor as double), 0)
        * 100, 0)) as bigint) as varchar) || '%' as parte_liberada,
    {_thousands("numero_convenios")} as convenios, {_thousands("numero_municipios")} as municipios,
    {_thousands("numero_orgaos")} as orgaos,
    coalesce(orgao_maior_gasto_nome, '—') as orgao_topo,
    case when orgao_maior_gasto_valor is not null then {_compact("orgao_maior_gasto_valor")} end as orgao_topo_valor,
    coalesce({_month_name("mes_pico_mes")}, '—') as mes_recorde,
    case when mes_pico_valor is not null then {_compact("mes_pico_valor")} end as mes_recorde_valor,
    coalesce(cast(periodo_inicio as varchar), '?') || ' a ' || coalesce(cast(periodo_fim as varchar), '?') as periodo
from k"""


ORACLE: dict[str, str] = {
    "flat_json_events": """
select event_id, cast(json_extract_string(props, '$.k') as int) as k,
    json_extract_string(props, '$.missing.leaf') as ausente
from events""",
    "staged_agreements": f"with {AGREEMENTS}\nselect {_STG_COLUMNS} from stg",
    "staged_amendments": f"{STAR_E}\nselect * from stge",
    "brl_normalise": f"""
with texts as (
    select o_orderkey, o_orderstatus, cast(o_totalprice as decimal(18, 2)) as preco, case
        when o_orderstatus = 'F' then {_money_text('o_totalprice')}
        when o_orderstatus = 'O' then '- ' || {_money_text('o_totalprice')}
        else cast(cast(o_totalprice as decimal(18, 2)) as varchar) end as texto
    from orders
)
select o_orderkey, texto,
    cast(case when o_orderstatus = 'O' then -preco else preco end as decimal(18, 2)) as valor,
    cast(case when o_orderstatus in ('F', 'O') and preco < 1000 then case when o_orderstatus = 'O' then -preco else preco end
        end as decimal(18, 2)) as valor_tolerante
from texts""",
    "latest_version_per_key": _VERSIONS,
    "latest_then_filter": _VERSIONS + " and l_returnflag is not null and l_shipdate >= date '1998-01-01'",
    "dim_geography": f"with {AGREEMENTS},{GEOGRAPHY}\nselect * from geo",
    "dim_agency": f"with {AGREEMENTS},{AGENCY}\nselect * from agency",
    "dim_author": f"{STAR_E}\nselect * from author",
    "dim_election_year": f"{STAR_E}\nselect * from election",
    "fct_agreements": f"{STAR}\nselect * from fct",
    "fct_amendments": f"{STAR_E}\nselect * from fcte",
    "kpis": _kpis("true"),
    "kpis_filtered_empty": _kpis("valor < 0"),
    "ranking_agencies": f"{_AGENCIES}\nselect * from ranking",
    "monthly_series": f"""{STAR}
select strftime(mes_referencia, '%Y-%m') as mes, {_sum("valor")} as valor_total, count(*) as numero_convenios
from fct where mes_referencia is not null group by mes_referencia""",
    "municipalities": f"{_PLACES}\nselect * from places",
    "kpis_amendments": f"""{STAR_E}
select {_sum("valor_empenhado")} as total_empenhado, {_sum("valor_pago")} as total_pago,
    {_sum("valor_resto_cancelado")} as total_cancelado, {_RATIO} as taxa_execucao_geral,
    count(*) as numero_emendas,
    count(distinct case when eh_parlamentar_individual then author.sk_autor_emenda end)
        as numero_parlamentares_individuais,
    min(ano) as ano_inicio, max(ano) as ano_fim
from fcte join author on fcte.sk_autor_emenda = author.sk_autor_emenda""",
    "ranking_authors": f"{_AUTHORS}\nselect * from authors",
    "amendments_by_year": f"""{STAR_E}
select election.ano, eh_ano_eleitoral, tipo_eleicao, posicao_mandato_federal,
    {_AMENDMENT_SUMS}, {_RATIO} as taxa_execucao, count(*) as numero_emendas
from fcte join election on fcte.ano = election.ano
group by election.ano, eh_ano_eleitoral, tipo_eleicao, posicao_mandato_federal""",
    "json_product_municipalities": f"""{_PLACES}
select codigo_ibge, nome, uf_sigla, uf_nome, regiao, cast(valor_total as double) as valor_total, numero_convenios
from places""",
    "json_product_authors": f"""{_AUTHORS}
select nome, tipo_emenda, individual, cast(valor_empenhado as double) as valor_empenhado,
    cast(valor_pago as double) as valor_pago, cast(valor_resto_cancelado as double) as valor_resto_cancelado,
    numero_emendas
from authors""",
    "json_product_stamp": f"""{STAR}
select count(*) as numero_convenios, '2001-08-01T06:00:00+00:00' as gerado_em,
    timestamp '2001-08-01 06:00:00' as momento
from fct""",
    "authors_notes": f"""{_AUTHORS},
counts as (select count(*) filter (where individual) as shown_from, count(*) as everyone from authors)
select shown_from as encontrados, case when shown_from > 50
    then 'Mostrando os 50 primeiros de ' || {_thousands("shown_from")} || ' autores, ordenado pela coluna selecionada.'
    else 'Mostrando ' || {_thousands("shown_from")} || ' autor(es).' end as nota
from counts
union all
select everyone, 'Mostrando ' || {_thousands("everyone")} || ' autor(es).' from counts""",
    "top15_customers": """
select 'Cliente ' || cast(o_custkey as varchar) as rotulo,
    cast(sum(cast(o_totalprice as decimal(18, 2))) as decimal(38, 2)) as valor_total
from orders group by o_custkey order by valor_total desc, o_custkey limit 15""",
    "representative_rows": """
select l_partkey, l_returnflag, l_linestatus, l_linenumber from (
    select *, row_number() over (
        partition by l_partkey
        order by l_returnflag nulls last, l_linestatus nulls last, l_linenumber nulls last) as r
    from lineitem)
where r = 1""",
    "sql_over_views": f"""{STAR}
select nome_regiao, cast(year(mes_referencia) as int) as ano, {_sum("valor")} as valor, count(*) as numero
from fct join geo on fct.sk_municipio = geo.sk_municipio group by 1, 2""",
    "json_product_kpis": f"""with k as ({_kpis("true")})
select * replace (
    cast(total_valor as double) as total_valor, cast(total_valor_liberado as double) as total_valor_liberado,
    cast(orgao_maior_gasto_valor as double) as orgao_maior_gasto_valor,
    cast(mes_pico_valor as double) as mes_pico_valor)
from k""",
    "dash_kpis": f"""{STAR}
select {_sum("valor")} as valor_total, {_sum("valor_liberado")} as valor_liberado,
    count(*) as numero_convenios, count(distinct fct.sk_municipio) as numero_municipios
from fct join geo on fct.sk_municipio = geo.sk_municipio where nome_regiao = 'ASIA'""",
    "dash_kpis_unfiltered": f"""{STAR}
select {_sum("valor")} as valor_total, {_sum("valor_liberado")} as valor_liberado,
    count(*) as numero_convenios, count(distinct fct.sk_municipio) as numero_municipios
from fct join geo on fct.sk_municipio = geo.sk_municipio""",
    "dash_kpis_sql": f"""{STAR}
select {_sum("valor")} as valor_total, {_sum("valor_liberado")} as valor_liberado,
    count(*) as numero_convenios, count(distinct fct.sk_municipio) as numero_municipios
from fct join geo on fct.sk_municipio = geo.sk_municipio where uf_nome = 'NATION_7'""",
    "dash_ranking": f"""{STAR}
select nome_orgao_superior as orgao, {_sum("valor")} as valor_total, cast(count(*) as bigint) as numero_convenios
from fct join agency on fct.sk_orgao_superior = agency.sk_orgao_superior
join geo on fct.sk_municipio = geo.sk_municipio
where nome_regiao = 'ASIA' group by nome_orgao_superior
order by valor_total desc nulls last, orgao limit 15""",
    "dash_series": f"""{STAR}
select mes_referencia as mes, {_sum("valor")} as valor_total, count(*) as numero_convenios
from fct join geo on fct.sk_municipio = geo.sk_municipio
where nome_regiao = 'ASIA' and uf_nome = 'NATION_7' and mes_referencia is not null
group by mes_referencia""",
    "dash_ranking_from_fact": f"""{STAR}
select nome_orgao_superior as orgao, {_sum("valor")} as valor_total, cast(count(*) as bigint) as numero_convenios
from fct join agency on fct.sk_orgao_superior = agency.sk_orgao_superior
join geo on fct.sk_municipio = geo.sk_municipio
where nome_regiao = 'ASIA' group by nome_orgao_superior
order by valor_total desc nulls last, orgao limit 15""",
    "dash_series_from_fact": f"""{STAR}
select mes_referencia as mes, {_sum("valor")} as valor_total, count(*) as numero_convenios
from fct join geo on fct.sk_municipio = geo.sk_municipio
where nome_regiao = 'ASIA' and uf_nome = 'NATION_7' and mes_referencia is not null
group by mes_referencia""",
    "dash_kpis_from_fact": f"""{STAR}
select {_sum("valor")} as valor_total, {_sum("valor_liberado")} as valor_liberado,
    count(*) as numero_convenios, count(distinct fct.sk_municipio) as numero_municipios
from fct join geo on fct.sk_municipio = geo.sk_municipio where nome_regiao = 'ASIA' and uf_nome = 'NATION_7'""",
    "scope_rollup": f"""{STAR},
placed as (
    select fct.*, nome_regiao, uf_nome, nome_municipio, nome_orgao_superior as orgao
    from fct join geo on fct.sk_municipio = geo.sk_municipio
    left join agency on fct.sk_orgao_superior = agency.sk_orgao_superior
),
levels as (select unnest(range(4)) as nivel),
named as (
    select nivel, case when nivel > 0 then nome_regiao end as nome_regiao, case when nivel > 1 then uf_nome end as uf_nome,
        case when nivel > 2 then nome_municipio end as nome_municipio, orgao, mes_referencia as mes, sk_municipio, valor, valor_liberado
    from placed cross join levels
)
select 'kpis' as assunto, cast(nivel as int) as nivel, nome_regiao, uf_nome, nome_municipio, cast(null as varchar) as orgao,
    cast(null as date) as mes, {_sum("valor")} as valor, {_sum("valor_liberado")} as liberado, count(*) as n,
    count(distinct sk_municipio) as lugares
from named group by nivel, nome_regiao, uf_nome, nome_municipio
union all
select 'orgao', cast(nivel as int), nome_regiao, uf_nome, nome_municipio, orgao, null, {_sum("valor")}, {_sum("valor_liberado")}, count(*), null
from named group by nivel, nome_regiao, uf_nome, nome_municipio, orgao
union all
select 'mes', cast(nivel as int), nome_regiao, uf_nome, nome_municipio, null, mes, {_sum("valor")}, {_sum("valor_liberado")}, count(*), null
from named where mes is not null group by nivel, nome_regiao, uf_nome, nome_municipio, mes""",
    "dash_year": f"{_YEARS}\nselect * from years",
    "dash_year_long": f"""{_YEARS}
select ano, eh_ano_eleitoral, tipo_eleicao, posicao_mandato_federal, 'Empenhado (prometido)' as medida,
    valor_empenhado as valor from years
union all
select ano, eh_ano_eleitoral, tipo_eleicao, posicao_mandato_federal, 'Pago (entregue)', valor_pago from years""",
    "year_sentence": f"""{_YEARS}
select string_agg('**' || cast(ano as varchar) || '**: ' || tipo_eleicao || ', ano '
    || cast(posicao_mandato_federal as varchar) || ' do mandato federal', ' · ' order by ano) as texto
from years""",
    "geo_table": f"with {AGREEMENTS},{GEOGRAPHY}\nselect nome_regiao, uf_nome, nome_municipio, codigo_ibge from geo",
    "geo_options_regions": f"with {AGREEMENTS},{GEOGRAPHY}\nselect distinct nome_regiao from geo",
    "geo_options_states": f"""with {AGREEMENTS},{GEOGRAPHY}
select distinct uf_sigla as valor, uf_nome || ' (' || uf_sigla || ')' as texto from geo where nome_regiao = 'ASIA'""",
    "geo_options_municipalities": f"""with {AGREEMENTS},{GEOGRAPHY}
select distinct codigo_ibge as valor, nome_municipio as texto from geo where uf_sigla = 'N7'""",
    "geo_names_states": f"""with {AGREEMENTS},{GEOGRAPHY}
select distinct uf_nome from geo where nome_regiao = 'ASIA'""",
    "geo_names_municipalities": f"""with {AGREEMENTS},{GEOGRAPHY}
select distinct nome_municipio from geo where nome_regiao = 'ASIA' and uf_nome = 'NATION_7'""",
    "kpi_texts": _kpi_texts("true"),
    "kpi_texts_empty": _kpi_texts("valor < 0"),
    "kpi_amendment_texts": f"""{STAR_E},
k as (
    select {_sum("valor_empenhado")} as e, {_sum("valor_pago")} as p, {_sum("valor_resto_cancelado")} as c,
        {_RATIO} as taxa, min(ano) as inicio, max(ano) as fim,
        count(distinct case when eh_parlamentar_individual then author.sk_autor_emenda end) as n
    from fcte join author on fcte.sk_autor_emenda = author.sk_autor_emenda
)
select {_compact("e")} as empenhado, {_compact("p")} as pago, {_compact("c")} as cancelado,
    {_percent("taxa")} as taxa_execucao, {_thousands("n")} as parlamentares,
    cast(inicio as varchar) || ' a ' || cast(fim as varchar) as anos
from k""",
    "series_texts": f"""{STAR},
serie as (
    select strftime(mes_referencia, '%Y-%m') as mes, sum(valor) as v, count(*) as n from fct group by mes_referencia
)
select mes, {_month_name("mes")} as rotulo, {_full("v")} as valor, {_thousands("n")} as convenios from serie""",
    "authors_table_texts": f"""{_AUTHORS},
top as (
    select * from authors where individual
    order by taxa_execucao desc nulls last, valor_empenhado desc nulls last, nome, tipo_emenda limit 50
)
select nome, tipo_emenda, {_full("valor_empenhado")} as valor_empenhado, {_full("valor_pago")} as valor_pago,
    {_full("valor_resto_cancelado")} as valor_resto_cancelado, {_percent("taxa_execucao")} as taxa_execucao,
    {_thousands("numero_emendas")} as numero_emendas
from top""",
    "top15_agencies": f"""{_AGENCIES}
select coalesce(nullif(sigla, ''), nome) as rotulo, valor_total from ranking
order by valor_total desc nulls last, codigo limit 15""",
    "top20_filtered": f"""{_PLACES},
found as (select * from places where regiao = 'ASIA'),
counted as (select count(*) as encontrados from found)
select codigo_ibge, nome || ' (' || uf_sigla || ')' as rotulo, valor_total, encontrados,
    case when encontrados > 20
        then 'Mostrando os 20 maiores de ' || translate(format('{{:,}}', encontrados), ',', '.')
            || ' municípios encontrados no filtro atual.'
        else 'Mostrando ' || translate(format('{{:,}}', encontrados), ',', '.')
            || ' município(s) no filtro atual.' end as nota
from found, counted order by valor_total desc nulls last, codigo_ibge limit 20""",
    "top15_authors": f"""{_AUTHORS},
found as (select * from authors where individual),
counted as (select count(*) as encontrados from found)
select nome, valor_empenhado, valor_pago, encontrados,
    case when encontrados > 15
        then 'Mostrando os 15 maiores de ' || translate(format('{{:,}}', encontrados), ',', '.')
            || ' autores no filtro atual.'
        else 'Mostrando ' || translate(format('{{:,}}', encontrados), ',', '.') || ' autor(es) no filtro atual.'
    end as nota
from found, counted order by valor_empenhado desc nulls last, nome, tipo_emenda limit 15""",
    "authors_sorted": f"""{_AUTHORS}
select nome, tipo_emenda, valor_empenhado, valor_pago, valor_resto_cancelado, taxa_execucao, numero_emendas
from authors where individual order by taxa_execucao desc nulls last, valor_empenhado desc nulls last, nome, tipo_emenda
limit 50""",
    "authors_sorted_text": f"""{_AUTHORS}
select nome, tipo_emenda, valor_empenhado, valor_pago, valor_resto_cancelado, taxa_execucao, numero_emendas
from authors order by nome nulls last, valor_empenhado desc nulls last, tipo_emenda limit 50""",
    "format_brl": f"""
select o_orderkey, {_reais('(o_totalprice / 1000)')} as unidades, {_reais('o_totalprice')} as milhares,
    {_reais('(o_totalprice * 1000)')} as milhoes, {_reais('(o_totalprice * 1000000)')} as bilhoes,
    {_reais('cast(null as double)')} as nulo
from orders""",
    "site_texts": f"""{STAR_E}
select codigo_emenda, valor_empenhado, {_compact('valor_empenhado')} as compacto,
    {_compact('cast(valor_empenhado * -1000 as decimal(18, 2))')} as compacto_negativo,
    'R$' || chr(160) || translate(format('{{:,.0f}}', cast(round(valor_pago, 0) as double)), ',', '.') as cheio,
    translate(format('{{:,}}', ano * 1000), ',', '.') as inteiro,
    case when taxa_execucao is null then '—' else cast(cast(round(taxa_execucao * 100) as int) as varchar) || '%' end
        as percentual
from fcte""",
    "date_texts": f"""
select o_orderkey, strftime(o_orderdate, '%Y-%m') as mes,
    {_MONTHS}[month(o_orderdate)] || ' de ' || strftime(o_orderdate, '%Y') as mes_nome,
    cast(date_trunc('month', o_orderdate) as date) as mes_inicio,
    strftime(o_orderdate, '%d/%m/%Y') as data_br, cast(o_orderdate as date) as data_lida
from orders""",
    "released_share_by_place": f"""{STAR}
select sk_municipio, coalesce(cast(sum(valor_liberado) as double) / nullif(cast(sum(valor) as double), 0) * 100, 0)
    as percentual
from fct group by sk_municipio""",
    "date_windows_28": """
with days as (select cast(o_orderdate as date) as dia from orders),
bounds as (select min(dia) as inicio, max(dia) as fim from days),
starts as (
    select inicio + cast(28 * n as int) as janela_inicio, fim
    from bounds, (select unnest(range(0, (select (fim - inicio) // 28 + 1 from bounds))) as n) steps
),
spans as (select janela_inicio, least(janela_inicio + 27, fim) as janela_fim from starts)
select janela_inicio, janela_fim, count(dia) as registros
from spans left join days on dia between janela_inicio and janela_fim
group by janela_inicio, janela_fim""",
    "default_windows": """
with days as (select cast(o_orderdate as date) as dia from orders),
newest as (select max(dia) as fim from days),
spans as (
    select 'padrao' as janela, fim - 90 as inicio, fim from newest
    union all select 'rolante', fim - 6, fim from newest
)
select janela, inicio, fim, count(*) as registros from spans join days on dia between inicio and fim
group by janela, inicio, fim""",
    "refresh_years": """
with years as (select cast(year(l_shipdate) as int) as ano from lineitem),
newest as (select max(ano) as ultimo from years)
select ano, ano between ultimo - 2 and ultimo as padrao, ano between ultimo - 1 and ultimo as atualizacao,
    ano in (1996, 1999, 2000) as lista, count(*) as registros
from years, newest group by ano, ultimo""",
    "load_window_replay": f"""{_EVENTS}
select event_id, event_type, janela_inicio, janela_fim from placed
where not (janela_inicio = inicio and event_type = 'error')""",
    "load_overlapping_windows": f"""{_EVENTS}
select event_id, event_type, case when dia > fim - 7 then fim - 6 else janela_inicio end as janela_inicio,
    case when dia > fim - 7 then fim else janela_fim end as janela_fim
from placed""",
    "load_empty_window": f"""{_EVENTS}
select event_id, janela_inicio, janela_fim from placed where janela_fim <> fim""",
    "load_reports": f"""{_EVENTS},
kept as (select count(*) as n from placed where janela_inicio = inicio and event_type <> 'error')
select 'convenios' as tabela, cast(0 as bigint) as removidas, count(*) as inseridas, false as aviso
from placed group by janela_inicio
union all
select 'convenios', (select count(*) from placed where janela_inicio = inicio), n, false from kept
union all
select 'convenios', n, 0, true from kept""",
    "load_streamed_windows": f"""{_EVENTS}
select event_id, event_type, janela_fim - 27 as janela_inicio, janela_fim from placed""",
    "load_streamed_late_file": f"""{_EVENTS}
select event_id, event_type, janela_fim - 27 as janela_inicio, janela_fim from placed""",
    "load_streamed_empty_interval": f"""{_EVENTS}
select event_id, event_type, janela_fim - 27 as janela_inicio, janela_fim from placed where janela_fim <> fim""",
    "load_reader_isolation": f"""{_EVENTS}
select 'antes' as leitura, event_id, event_type, janela_inicio, janela_fim from placed
union all
select 'depois', event_id, event_type, janela_inicio, janela_fim from placed
where janela_fim <> fim and not (janela_inicio = inicio and event_type = 'error')""",
    "load_cut_off": f"""{_EVENTS}
select event_id, event_type, timestamptz '2024-02-01 00:00:00+00' as carregado_em, janela_inicio, janela_fim from placed""",
    "load_two_writers": f"""{_EVENTS}
select event_id, event_type, janela_inicio, janela_fim from placed""",
    "load_snapshot_undated": """
select cast(case when l_linenumber <> 1 then year(l_shipdate) end as int) as ano_snapshot, count(*) as registros,
    cast(sum(cast(l_extendedprice as decimal(18, 2))) as decimal(38, 2)) as valor
from lineitem group by 1""",
    "evolve_then_load": _YEAR_TOTALS.format(
        value="cast(case when ano_snapshot = 1999 then 3 * price else price end as decimal(18, 2))"
    ),
    "load_snapshot_replay": _YEAR_TOTALS.format(
        value="cast(case when ano_snapshot in (1999, 2000) then 3 * price else price end as decimal(18, 2))"
    ),
    "load_snapshot_empty": _YEAR_TOTALS.format(value="price"),
    "evolve_year_column": _YEAR_TOTALS.format(value="price"),
    "landing_round_trip": f"with {AGREEMENTS}\nselect {_STG_COLUMNS} from typed",
    "landing_ingest": "select event_id, event_type from events where event_type <> 'error'",
    "quality_report": _contract_sql(),
    "quality_report_sources": "\nunion all ".join(
        [
            _unique("lineitem", "l_orderkey", "lineitem"),
            _where("not_null", "lineitem", "l_shipdate", "lineitem"),
            _unique("orders", "o_orderkey", "orders"),
            _accepted("orders", "o_orderstatus", "orders", "'F', 'O'"),
            _where("non_negative", "customer", "c_acctbal", "customer"),
            _where("not_null", "customer", "c_name", "customer"),
        ]
    ),
    "duplicate_keys": """
select l_orderkey, count(*) as n_records from lineitem where l_orderkey is not null
group by l_orderkey having count(*) > 1""",
    "unexpected_values": """
select o_orderstatus, count(*) as n_records from orders where o_orderstatus not in ('F', 'O')
group by o_orderstatus""",
    "negative_balances": "select * from customer where c_acctbal < 0",
    "newest_kept_by_load": f"""with {AGREEMENTS}
select id_convenio, cast(case when situacao = 'F' and orgao_superior_codigo <> '5-LOW' then 2 * valor else valor end as decimal(18, 2)) as valor,
    situacao,
    case when situacao = 'F' and orgao_superior_codigo <> '5-LOW' then date '2001-07-08' else date '2001-07-07' end as janela_fim
from stg""",
    "interval_runs": f"""with {AGREEMENTS}
select orgao_superior_codigo as codigo, min(orgao_superior_nome) as nome, min(orgao_superior_sigla) as sigla,
    cast(sum(case when situacao = 'F' then 2 * valor else valor end) as decimal(38, 2)) as valor_total,
    count(*) as numero_convenios
from stg group by orgao_superior_codigo""",
}
