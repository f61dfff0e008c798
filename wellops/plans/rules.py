"""Rule sets of the three validated datasets.

The value lists are fixed values that landing files and reports share; callers may pass others.
"""

from __future__ import annotations

from collections.abc import Sequence

from wellops.functions.columns import today
from wellops.operators.quality import Rule, expect, expect_or_drop, expect_or_fail

WELL_STATUSES = ("Produzindo", "Parado", "Manutencao", "Abandonado", "Completacao")
ORDER_STATUSES = ("Aberta", "Em Execucao", "Concluida", "Cancelada", "Aguardando Material")
ORDER_PRIORITIES = ("1-Emergencia", "2-Urgente", "3-Normal", "4-Planejada")
OUTLIER_OIL_BBL = 50_000
MAX_BSW_PCT = 100


def _one_of(column: str, values: Sequence[str]) -> str:
    quoted = ", ".join("'" + v.replace("'", "\\'") + "'" for v in values)
    return f"{column} IN ({quoted})"


def well_rules(as_of: str | None = None, statuses: Sequence[str] = WELL_STATUSES) -> list[Rule]:
    return [
        expect_or_drop("coordinates_present", "latitude IS NOT NULL AND longitude IS NOT NULL"),
        expect_or_drop("depth_positive", "depth_m > 0"),
        expect_or_drop("drilled_not_in_future", f"drilled_on <= {today(as_of)}"),
        expect("status_known", _one_of("status", statuses)),
        expect_or_fail("well_id_present", "well_id IS NOT NULL"),
    ]


def production_rules(as_of: str | None = None) -> list[Rule]:
    return [
        expect_or_drop("oil_positive", "oil_bbl > 0"),
        expect_or_drop("date_not_in_future", f"prod_date <= {today(as_of)}"),
        expect("bsw_in_range", f"bsw_pct BETWEEN 0 AND {MAX_BSW_PCT}"),
        expect("oil_plausible", f"oil_bbl < {OUTLIER_OIL_BBL}"),
        expect_or_fail("well_id_present", "well_id IS NOT NULL"),
    ]


def order_rules(statuses: Sequence[str] = ORDER_STATUSES,
                priorities: Sequence[str] = ORDER_PRIORITIES) -> list[Rule]:
    return [
        expect_or_drop("cost_positive", "est_cost > 0"),
        expect("status_known", _one_of("status", statuses)),
        expect("priority_known", _one_of("priority", priorities)),
        expect("description_present", "description IS NOT NULL"),
        expect_or_drop("well_id_present", "well_id IS NOT NULL"),
    ]
