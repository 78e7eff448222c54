"""Many analyses from one scan of the table.

Nearly all analyses count rows by a few columns of small domain. ``together`` works out the
sets of columns that its analyses need, leaves out those that a larger set holds already, and
counts all sets by one ``GROUPING SETS`` aggregation: one scan, partial sums in every task, one
shuffle of counted rows. The counts go to a scratch table partitioned by set, where each analysis
reads its own set, as a frame with the column ``freq.COUNT``, which the operators take for the
rows it stands for.

The number of scans does not depend on the number of analyses: one for the counts (with
dashboard filters one per kind of filter, at most three), and one for the analyses that do not
count (exact sums of weights).

Ages and incomes are counted by value, as distinct as they are: counted values only save
work where values repeat, but they are never more than the rows, and stay distributed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import any_answer
from ..operators.filters import SYMPTOMATIC, survey_filter
from ..operators.freq import COUNT
from ..schema import MONTH_COLUMN as M, YES
from ..session import scratch_folder
from ..sources.files import delete_folder
from . import analyses as A

Analysis = Callable[[DataFrame], DataFrame]
CARE, HOSPITAL, WORKED, AWAY = "ProcurouAtendimento_desc", "InternadoHospital_desc", "Trabalhou_desc", "AfastadoTrabalho_desc"
BAND, AID, INCOME = "FaixaRendimento_desc", "AuxilioEmergencial_desc", "RendimentoHabitual_Valor"

#: The columns by which an analysis counts.
COUNTS_BY: dict[Analysis, tuple[str, ...]] = {
    A.qa1_uf_top: ("uf_desc",),
    A.qa2_age_describe: ("Idade",), A.qa2_age_hist: ("Idade",), A.qa2_age_kde: ("Idade",), A.qa2_age_box: ("Idade",),
    A.qa3_sexo: ("sexo_desc",),
    A.qa4_cor_raca: ("cor_raca_desc",),
    A.qa5_escolaridade: ("escolaridade_desc",),
    A.qa6_rendimento: (BAND,), A.qc4_rendimento_informed: (BAND,),
    A.qa7_income_describe: (INCOME,), A.qa7_income_hist: (INCOME,), A.qa7_income_quantiles: (INCOME,), A.qa7_income_box: (INCOME,),
    A.qa8_ocupacao_informed: ("PosicaoOcupacao_desc",),
    A.qb1_symptom_prevalence: tuple(A.SYMPTOM_COLS),
    A.qb2_care_among_symptomatic: (SYMPTOMATIC, CARE),
    A.qb3_hosp_among_care: (SYMPTOMATIC, CARE, HOSPITAL),
    A.qb4_plan_x_care: (SYMPTOMATIC, "PlanoSaude_desc", CARE),
    A.qc1_trabalhou: (WORKED,), A.qc1_trabalhou_yes_no: (WORKED,),
    A.qc2_away_yes_no: (AWAY,), A.qc2_away_all_top5: (AWAY,),
    A.qc21_away_active_not_working: ("Idade", WORKED, AWAY), A.qc21_away_active_yes_no: ("Idade", WORKED, AWAY),
    A.qc5_auxilio: (AID,),
    A.qd1_trend_symptoms: (M, *A.SYMPTOM_COLS),
    A.qd2_trend_care: (M, SYMPTOMATIC, CARE),
    A.qd3_trend_work_aid: (M, WORKED, AID),
    A.qd_month_answer_shares: (M, "Febre_desc"),
    A.qe1_profile_care_seekers: (SYMPTOMATIC, CARE, "Idade", "sexo_desc", "escolaridade_desc"),
    A.qe2_symptoms_of_care_seekers: (CARE, *A.SYMPTOM_COLS),
    A.qe3_income_x_hosp: (SYMPTOMATIC, CARE, HOSPITAL, BAND),
    A.qk_kpi: ("Febre_desc", AID), A.qk_kpi_text: ("Febre_desc", AID),
    A.qo_filter_options: (M, "uf_desc", "sexo_desc"),
    A.month_labels: (M,),
}

#: Analyses of several columns, each for itself, and what they do with (measure, value, n).
EACH_COLUMN: dict[Analysis, tuple[list[str], Analysis]] = {A.q2_first_look: (A.FIRST_LOOK, A.most_frequent)}


#: Results that are worked on side by side; each is a few small jobs on counted rows.
AT_ONCE = 8


def at_once(work: Callable, fns: list[Analysis]) -> dict:
    """{fn: work(fn)}, ``AT_ONCE`` at a time; the first failure is raised."""
    with ThreadPoolExecutor(AT_ONCE) as pool:
        return dict(zip(fns, pool.map(work, fns)))


def _needed(fn: Analysis) -> list[tuple[str, ...]]:
    return [(c,) for c in EACH_COLUMN[fn][0]] if fn in EACH_COLUMN else [COUNTS_BY[fn]]


def covering_sets(needed: list[tuple[str, ...]]) -> list[frozenset[str]]:
    """The sets that no other one holds."""
    sets = set(map(frozenset, needed))
    return sorted((s for s in sets if not any(s < other for other in sets)), key=sorted)


def count_sets(df: DataFrame, sets: list[frozenset[str]]) -> tuple[DataFrame, dict[frozenset[str], int]]:
    """Counts by every set, (set columns, else NULL; __set; COUNT), and the number of each set."""
    cols = sorted(frozenset().union(*sets))
    frame = df.withColumn(SYMPTOMATIC, any_answer(A.SYMPTOM_COLS, YES)) if SYMPTOMATIC in cols else df
    by = [F.col(c) for c in cols]
    counts = frame.select(cols).groupingSets([[F.col(c) for c in sorted(s)] for s in sets], *by).agg(
        F.grouping_id(*by).cast(T.LongType()).alias("__set"), F.count(F.lit(1)).alias(COUNT))
    # a bit of grouping_id is set where the column is not in the set, the first column has the highest bit
    number = {s: sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in s) for s in sets}
    return counts, number


class _Counted:
    """The counts of one scan, stored by set."""

    def __init__(self, df: DataFrame, fns: list[Analysis], folder: str):
        self.sets = covering_sets([need for fn in fns for need in _needed(fn)])
        counts, self.number = count_sets(df, self.sets)
        counts.write.partitionBy("__set").parquet(folder)
        self.table = df.sparkSession.read.schema(counts.schema).parquet(folder)  # no files, no rows

    def rows(self, cols: tuple[str, ...]) -> DataFrame:
        holder = min((s for s in self.sets if set(cols) <= s), key=lambda s: (len(s), sorted(s)))
        return self.table.where(F.col("__set") == self.number[holder]).select(*cols, COUNT)

    def result(self, fn: Analysis) -> DataFrame:
        if fn not in EACH_COLUMN:
            return fn(self.rows(COUNTS_BY[fn]))
        cols, finish = EACH_COLUMN[fn]
        return finish(reduce(DataFrame.unionByName, [
            self.rows((c,)).groupBy(F.lit(c).alias("measure"), F.col(c).cast("string").alias("value")).agg(F.sum(COUNT).alias("n"))
            for c in cols]))


@contextmanager
def together(df: DataFrame, fns: list[Analysis], uf: str | None = None, sexo: str | None = None,
             mes: str | None = None) -> Iterator[dict[Analysis, DataFrame]]:
    """The result of every analysis under the dashboard's filters, equal to ``analyses.dashboard_view``.

    The results read a scratch table under the session's checkpoint folder, which goes when the block is left.
    """
    folder = f"{scratch_folder(df.sparkSession)}/together-{uuid.uuid4().hex}"
    results: dict[Analysis, DataFrame] = {}
    kinds: dict[tuple, list[Analysis]] = {}
    for fn in dict.fromkeys(fns):
        if fn in COUNTS_BY or fn in EACH_COLUMN:
            kinds.setdefault(tuple(sorted(A.filters_of(fn, uf, sexo, mes).items(), key=str)), []).append(fn)
        else:
            results[fn] = A.dashboard_view(fn, df, uf=uf, sexo=sexo, mes=mes)
    try:
        for i, (kept, group) in enumerate(kinds.items()):
            counted = _Counted(survey_filter(df, **dict(kept)), group, f"{folder}/{i}")
            results.update(at_once(counted.result, group))
        yield {fn: results[fn] for fn in dict.fromkeys(fns)}
    finally:
        delete_folder(df.sparkSession, folder)
