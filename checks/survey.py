"""A survey read out of the order tables: one order is one respondent, its year the edition.

Every answer is an expression over the order row (`k` order key, `c` customer key, `ano` year,
`price`, `st` status, `pr` priority). The expressions are plain SQL that Spark and the comparison
engine both read, so each side builds its own input. All orders of all years take part: the years
1999-2001 are the core editions, 1995-1998 the older ones.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.functions.scalars import quoted
from surveyloom.plans import vocabulary as v
from surveyloom.sources.folders import new_path

CORE_YEARS = (1999, 2000, 2001)
HISTORY_YEARS = (1995, 1996, 1997, 1998)
FIRST, LAST = CORE_YEARS[0], CORE_YEARS[-1]

# The header style each year borrows.
CORE_HEADERS = dict(zip(CORE_YEARS, (v.CORE_HEADERS[e] for e in v.CORE_EDITIONS)))
HISTORY_HEADERS = dict(zip(HISTORY_YEARS, (v.HEADERS_2019, v.HEADERS_2021, v.HEADERS_2022, v.HEADERS_2022)))

ALL_YEARS = (*HISTORY_YEARS, *CORE_YEARS)
HEADERS = {**HISTORY_HEADERS, **CORE_HEADERS}

ROLE_TEXTS = (
    ("Engenheiro de Dados/Data Engineer", "Engenharia/Arquitetura de Dados"),
    ("Analista de Dados/Data Analyst", "Análise de Dados"),
    ("Cientista de Dados/Data Scientist", "Ciência de Dados"),
    ("Analista de BI/BI Analyst", "Business Intelligence"),
    ("Analytics Engineer", "Analytics Engineer"),
    ("Engenheiro de Machine Learning/ML Engineer", "ML/AI Engineer"),
    ("Analista de Negócios/Business Analyst", "Análise de Negócios"),
    ("Desenvolvedor ou Engenheiro de Software", "Eng. de Software"),
    ("Data Product Manager", "Produto (DPM/PM)"),
    ("Administrador de Banco de Dados", "DBA"),
    ("Estatístico", "Estatística/Economia"),
    ("PROFESSOR", "Professor/Pesquisador"),
    ("Outra Opção de Analista de Dados", "Outros"),
    ("Analista de Suporte", "Outros"),
    ("Arquiteto de Dados", "Engenharia/Arquitetura de Dados"),
    ("Data Architect", "Outros"),
    ("Feedback Lead", "DBA"),
)
MODEL_TEXTS = (
    ("Modelo 100% remoto", "100% remoto"),
    ("Modelo 100% PRESENCIAL", "100% presencial"),
    ("Modelo híbrido com dias fixos", "Híbrido (dias fixos)"),
    ("Modelo Híbrido flexível", "Híbrido flexível"),
    ("Modelo hibrido flexivel", "Híbrido flexível"),
    ("Sem modelo definido", "Outro"),
)
PRIORITY_TEXTS = (
    ("Sim, é nossa principal prioridade", "1. Principal prioridade da empresa"),
    ("Sim, está entre as principais", "2. Entre as principais (2-4 anos)"),
    ("Mais ou menos, há iniciativas", "3. Iniciativas isoladas, sem foco"),
    ("Não é uma iniciativa da empresa", "4. Não é prioridade"),
    ("Não sei opinar", "5. Não sabe opinar"),
    ("Resposta nova", "5. Não sabe opinar"),
)


def lit(text: str) -> str:
    assert "'" not in text and "\\" not in text
    return f"'{text}'"


def pick(number: str, texts: Sequence[str]) -> str:
    """One of the texts, chosen by a number."""
    assert not any("|" in t for t in texts)
    return f"split_part({lit('|'.join(texts))}, '|', CAST(({number}) % {len(texts)} AS INT) + 1)"


def unless(test: str, expr: str) -> str:
    return f"CASE WHEN {test} THEN NULL ELSE {expr} END"


def _both(number: str, pairs: Sequence[tuple[str, str]], skip: str) -> tuple[str, str]:
    return tuple(unless(skip, pick(number, [p[i] for p in pairs])) for i in (0, 1))


UNPAID = "k % 12 = 0"
MANAGER = "c % 5 = 0"
BAND = "CAST(floor(price / 10000) AS INT)"

_role_raw, _role = _both("c", ROLE_TEXTS, MANAGER)
_now_raw, _now = _both("c + ano", MODEL_TEXTS, UNPAID)
_ideal_raw, _ideal = _both("k + c", MODEL_TEXTS[:5], UNPAID)
_ai_raw, _ai = _both("c + k", PRIORITY_TEXTS, f"NOT ({MANAGER})")

PAY_TEXT = f"""CASE WHEN {UNPAID} THEN NULL WHEN k % 89 = 0 THEN 'a combinar'
 WHEN {BAND} = 0 THEN 'Menos de R$ 10.000/mês'
 WHEN {BAND} >= 40 THEN 'Acima de R$ 400.001/mês'
 WHEN k % 97 = 0 THEN concat('de R$ ', CAST({BAND} AS STRING), '0.001/mês a R$ ', CAST({BAND} + 1 AS STRING), '000/mês')
 ELSE concat('de R$ ', CAST({BAND} AS STRING), '0.001/mês a R$ ', CAST({BAND} + 1 AS STRING), '0.000/mês') END"""
PAY_MIDPOINT = f"""CASE WHEN {UNPAID} OR k % 89 = 0 THEN NULL
 WHEN {BAND} = 0 THEN CAST(5000 AS DOUBLE)
 WHEN {BAND} >= 40 THEN CAST(450001.125 AS DOUBLE)
 ELSE CAST({BAND} * 10000 + 5000.5 AS DOUBLE) END"""

LAYOFF_TEXT = pick("k", ("Sim, ocorreu",) * 2 + ("Não ocorreu",) * 4 + ("Prefiro não responder",))
LAYOFF = "CASE WHEN k % 7 < 2 THEN 1 WHEN k % 7 < 6 THEN 0 END"

# Answers that need no reading: the harmonised column holds the text as given.
_PLAIN = {
    "id": "CAST(c AS STRING)",
    "faixa_idade": pick("c", ("17-21", "22-24", "25-29", "30-34", "35-39", "40-44")),
    "genero": unless("k % 211 = 0", "CASE st WHEN 'F' THEN 'Feminino' WHEN 'O' THEN 'Masculino' ELSE 'Outro' END"),
    "cor_raca": pick("c", ("Branca", "Parda", "Preta", "Amarela", "Indígena")),
    "pcd": pick("c", ("Não", "Sim", "Prefiro não informar")),
    "uf": pick("c", ("São Paulo (SP)", "Minas Gerais (MG)", "Bahia (BA)", "Paraná (PR)", "Pará (PA)", "Goiás (GO)")),
    "regiao": "CASE WHEN c % 50 = 0 THEN '' ELSE rname END",
    "nivel_ensino": pick("c", ("Graduação/Bacharelado", "Pós-graduação", "Mestrado", "Doutorado ou Phd")),
    "area_formacao": pick("c", ("Computação / Engenharia de Software", "Outras Engenharias", "Estatística, Matemática")),
    "situacao_trabalho": pick("k", ("Empregado (CLT)", "Empreendedor ou Empregado (CNPJ)", "Estagiário")),
    "setor": pick("c", ("Finanças ou Bancos", "Varejo", "Tecnologia/Fábrica de Software", "Indústria")),
    "num_funcionarios": pick("c", ("de 1 a 5", "de 101 a 500", "Acima de 3.000")),
    "cargo_gestor": unless(f"NOT ({MANAGER})", pick("k", ("Gerente/Head", "Diretor/VP", "Team Leader/Tech Leader"))),
    "cargo": _role_raw,
    "nivel": """CASE pr WHEN '1-URGENT' THEN 'Sênior' WHEN '2-HIGH' THEN 'Pleno' WHEN '3-MEDIUM' THEN 'Júnior'
 WHEN '5-LOW' THEN CASE WHEN ano = 2001 THEN 'Especialista/Staff+' ELSE 'Júnior' END END""",
    "faixa_salarial": PAY_TEXT,
    "tempo_exp_dados": pick("c", ("Menos de 1 ano", "de 1 a 2 anos", "de 3 a 4 anos", "Mais de 10 anos")),
    "entrevistas_6m": pick("k", ("Não participei", "Sim, fiz entrevistas", "Sim, e fui aprovado")),
    "mudar_emprego_6m": unless(UNPAID, pick("k + c", (
        "Estou em busca", "Não estou buscando, mas considero", "Não pretendo mudar", "Pretendo mudar de área"))),
    "layoff": LAYOFF_TEXT,
    "modelo_atual": _now_raw,
    "modelo_ideal": _ideal_raw,
    "atitude_presencial": pick("k", ("Vou aceitar", "Vou procurar outra oportunidade", "Ainda não sei")),
    "prioridade_ia": _ai_raw,
    "atuacao": pick("c", ("Análise de Dados/BI", "Ciência de Dados/Machine Learning/AI", "Engenharia de Dados")),
}

# Yes/no answers: 1, 0 or NULL where the question was not asked.
_ITEM_FLAGS = {
    "lang_sql": "has_r",
    "lang_r": "has_a",
    "lang_python": "has_n",
    "cloud_aws": "has_disc",
    "cloud_gcp": "has_bulk",
    "cloud_azure": unless("ano = 1995", "has_tax"),
}
_FLAGS = dict(_ITEM_FLAGS)
_FLAGS["cloud_onprem"] = "CASE WHEN k % 13 = 0 THEN NULL WHEN (k + c) % 9 < 2 THEN 1 ELSE 0 END"
for _i, _c in enumerate(c for c in v.HEADERS_2025 if c.startswith(("bi_", "genai_", "crit_", "des_"))):
    _skip = {"bi_": "k % 13 = 0", "gen": "k % 7 = 3", "cri": "k % 17 = 5", "des": f"NOT ({MANAGER})"}[_c[:3]]
    _FLAGS[_c] = unless(_skip, f"CASE WHEN (k * 7 + c * 3 + {_i}) % 10 < {_i % 7 + 2} THEN 1 ELSE 0 END")
_FLAGS["bi_qlik"] = unless("ano = 1999", _FLAGS["bi_qlik"])
_FLAGS["gestor"] = f"CASE WHEN c % 11 = 0 THEN NULL WHEN {MANAGER} THEN 1 ELSE 0 END"
_FLAGS["satisfeito"] = f"CASE WHEN {UNPAID} THEN NULL WHEN k % 3 > 0 THEN 1 ELSE 0 END"

AGE = unless("k % 31 = 0", "CAST(18 + c % 50 AS INT)")
_AGE_TEXT = """CASE WHEN k % 31 = 0 THEN CASE WHEN k % 2 = 0 THEN 'abc' END
 WHEN ano = 2000 THEN concat(CAST(18 + c % 50 AS STRING), '.0')
 WHEN ano = 2001 AND k % 3 = 0 THEN concat(CAST(18 + c % 50 AS STRING), '.9')
 ELSE CAST(18 + c % 50 AS STRING) END"""

_DERIVED = {
    "ano": "ano",
    "salario_pm": PAY_MIDPOINT,
    "cargo_grupo": _role,
    "modelo_atual_h": _now,
    "modelo_ideal_h": _ideal,
    "prioridade_ia_h": _ai,
    "layoff_sim": LAYOFF,
}

# The harmonised layer as it should come out, in layer order; and the same answers for the marts,
# where pay is the order price itself so that medians run over a wide, continuous domain.
SILVER = {c: {**_PLAIN, **_FLAGS, "idade": AGE}[c] for c in v.HEADERS_2025} | _DERIVED
ANSWERS = SILVER | {"salario_pm": unless(UNPAID, "price"), "k": "k", "c": "c"}
SILVER["regiao"] = unless("c % 50 = 0", "rname")  # an empty CSV field, quoted or not, reads as NULL
LONG = {c: SILVER[c] for c in v.LONG_COLUMNS}


# How each edition spells yes and no.
_SPELLINGS = {1995: ("1", "0"), 1996: ("1.0", "0.0"), 1997: ("TRUE", "false"), 1998: ("1", "0"),
              1999: ("1.0", "0.0"), 2000: ("True", "FALSE"), 2001: ("1", "0")}


def _spelled(flag: str, year: int | None) -> str:
    """A 0/1 answer as typed; unanswered is empty or a text that is no flag. No year: by `ano`."""
    if year is None:
        yes, no = (
            f"split_part({lit('|'.join(s[i] for s in _SPELLINGS.values()))}, '|', ano - {min(_SPELLINGS) - 1})"
            for i in (0, 1)
        )
    else:
        yes, no = (lit(t) for t in _SPELLINGS[year])
    return f"coalesce(CASE {flag} WHEN 1 THEN {yes} WHEN 0 THEN {no} END, CASE WHEN k % 4 = 1 THEN 'Sim' END)"


def raw_answers(year: int | None = None) -> dict[str, str]:
    """Raw text of every answer, before harmonisation."""
    def text(c: str) -> str:
        if c in _FLAGS:
            return _spelled(f"({_FLAGS[c]})", year)
        return _AGE_TEXT if c == "idade" else _PLAIN[c]

    return {c: text(c) for c in v.HEADERS_2025}


_ITEM_MARKS = {
    "has_r": "l_returnflag = 'R'",
    "has_a": "l_returnflag = 'A'",
    "has_n": "l_returnflag = 'N'",
    "has_disc": "l_discount >= 0.05",
    "has_bulk": "l_quantity >= 40",
    "has_tax": "l_tax >= 0.06",
}
_BASE = {
    "k": "o_orderkey",
    "c": "o_custkey",
    "ano": "CAST(year(o_orderdate) AS INT)",
    "price": "o_totalprice",
    "st": "o_orderstatus",
    "pr": "o_orderpriority",
}
_CORE_DATES = "o_orderdate >= TIMESTAMP{ntz} '1999-01-01 00:00:00'"
_OLDER_DATES = "o_orderdate < TIMESTAMP{ntz} '1999-01-01 00:00:00'"


_TEXTS = raw_answers() | {"k": "k", "ano": "ano", "price": "price"}


def _uses(exprs: Iterable[str], names: Iterable[str]) -> bool:
    joined = " ".join(exprs)
    return any(n in joined for n in names)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _orders(spark: SparkSession, sf_dir: str, exprs: Sequence[str], dates: str = "") -> DataFrame:
    """The base rows with only the joins the wanted answers need."""
    return _with_places(spark, sf_dir, _with_items(spark, sf_dir, exprs, dates), exprs)


def _with_items(spark: SparkSession, sf_dir: str, exprs: Sequence[str], dates: str = "") -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    if dates:
        orders = orders.filter(dates.format(ntz="_NTZ"))
    rows = orders.selectExpr(*[f"{e} AS {n}" for n, e in _BASE.items()])
    if _uses(exprs, _ITEM_MARKS):
        wanted = {n: e for n, e in _ITEM_MARKS.items() if _uses(exprs, [n])}
        items = _table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
            *[F.expr(f"max(CASE WHEN {e} THEN 1 ELSE 0 END)").alias(n) for n, e in wanted.items()]
        )
        rows = rows.join(items, rows["k"] == items["l_orderkey"], "left").drop("l_orderkey")
    return rows


def _with_places(spark: SparkSession, sf_dir: str, rows: DataFrame, exprs: Sequence[str]) -> DataFrame:
    if _uses(exprs, ["rname"]):
        places = (
            _table(spark, sf_dir, "nation")
            .join(_table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select("n_nationkey", F.col("r_name").alias("rname"))
        )
        homes = (
            _table(spark, sf_dir, "customer")
            .join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey"))
            .select("c_custkey", "rname")
        )
        rows = rows.join(homes, rows["c"] == homes["c_custkey"], "left").drop("c_custkey")
    return rows


def _view(spark: SparkSession, sf_dir: str, spec: dict[str, str], columns: Sequence[str], dates: str) -> DataFrame:
    chosen = list(columns) or list(spec)
    exprs = [spec[c] for c in chosen]
    return _orders(spark, sf_dir, exprs, dates).selectExpr(*[f"{e} AS {c}" for c, e in zip(chosen, exprs)])


def core(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Answers of the core editions; name the columns so that unused joins are not built."""
    return _view(spark, sf_dir, ANSWERS, columns, _CORE_DATES)


def every(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The same answers for all editions."""
    return _view(spark, sf_dir, ANSWERS, columns, "")


def banded(spark: SparkSession, sf_dir: str, *columns: str, core_only: bool = False) -> DataFrame:
    """The answers with pay as the midpoint of a band, as the harmonised layer has it."""
    return _view(spark, sf_dir, SILVER, columns, _CORE_DATES if core_only else "")


def long_series(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return _view(spark, sf_dir, LONG, columns, "")


def texts(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The raw answers of all editions under their harmonised names, as typed."""
    return _view(spark, sf_dir, _TEXTS, columns, "")


def _dates(first: int, last: int) -> str:
    return (f"o_orderdate >= TIMESTAMP_NTZ '{first}-01-01 00:00:00' "
            f"AND o_orderdate < TIMESTAMP_NTZ '{last + 1}-01-01 00:00:00'")


def _raw_spec(year: int, extra: dict[str, str] | None) -> dict[str, str]:
    answers = raw_answers(year)
    return {HEADERS[year][c]: answers[c] for c in HEADERS[year]} | (extra or {})


def _typed(rows: DataFrame, spec: dict[str, str]) -> DataFrame:
    return rows.selectExpr(*[f"CAST({e} AS STRING) AS {quoted(h)}" for h, e in spec.items()])


def raw_edition(spark: SparkSession, sf_dir: str, year: int, extra: dict[str, str] | None = None) -> DataFrame:
    """One edition as it would arrive: text only, under the headers of its year."""
    spec = _raw_spec(year, extra)
    return _typed(_orders(spark, sf_dir, list(spec.values()), _dates(year, year)), spec)


def raw_editions(
    spark: SparkSession, sf_dir: str, years: Sequence[int], extra: dict[str, str] | None = None,
) -> dict[int, DataFrame]:
    """Several editions as they would arrive, from orders that are joined to their items once and written by year.

    Items carry no date, so each edition that is read out of the order tables by itself shuffles the items of all.
    Customers are joined to the editions that ask where they live, as in `raw_edition`.
    """
    specs = {year: _raw_spec(year, extra) for year in years}
    exprs = [e for spec in specs.values() for e in spec.values()]
    rows = _with_items(spark, sf_dir, exprs, _dates(min(years), max(years))).filter(F.col("ano").isin(*years))
    folder = new_path(spark, "base")
    rows.write.partitionBy("ano").parquet(folder)
    kept = spark.read.schema(rows.schema).parquet(folder)
    return {
        year: _typed(_with_places(spark, sf_dir, kept.filter(F.col("ano") == year), list(spec.values())), spec)
        for year, spec in specs.items()}


# --- the same input for the comparison engine -------------------------------------

def _sql_view(spec: dict[str, str], dates: str) -> str:
    columns = ",\n".join(f"{e} AS {c}" for c, e in spec.items())
    where = f"WHERE {dates.format(ntz='')}" if dates else ""
    marks = ", ".join(f"max(CASE WHEN {e} THEN 1 ELSE 0 END) AS {n}" for n, e in _ITEM_MARKS.items())
    base = ", ".join(f"{e} AS {n}" for n, e in _BASE.items())
    return f"""SELECT {columns} FROM (
 SELECT {base}, {", ".join(_ITEM_MARKS)}, r_name AS rname
 FROM orders
 LEFT JOIN (SELECT l_orderkey, {marks} FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey
 LEFT JOIN customer ON o_custkey = c_custkey
 LEFT JOIN nation ON c_nationkey = n_nationkey
 LEFT JOIN region ON n_regionkey = r_regionkey
 {where})"""


_SQL_VIEWS = {
    "core": _sql_view(ANSWERS, _CORE_DATES),
    "every": _sql_view(ANSWERS, ""),
    "serie": _sql_view(LONG, ""),
    "silver": _sql_view(SILVER, _CORE_DATES),
    "texts": _sql_view(_TEXTS, ""),
    "silver_every": _sql_view(SILVER | {"k": "k"}, ""),
}


def with_views(sql: str, *names: str) -> str:
    """A comparison query over the named survey views."""
    body = sql.strip()
    views = ",\n".join(f"{n} AS ({_SQL_VIEWS[n]})" for n in names)
    if body[:5].upper() == "WITH ":
        return f"WITH {views},\n{body[5:]}"
    return f"WITH {views}\n{body}"
