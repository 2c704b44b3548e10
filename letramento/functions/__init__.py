"""Column expressions (no actions, no UDFs)."""

from .dims import (DEPENDENCIA, REDE_BY_CODE, REDE_BY_NAME, UF_TABLE, lookup,
                   region_from_uf, state_prefix, uf_from_code)
from .measures import (amplitude, attainment, classify, column_sum, criticality, gap,
                       literate_flag, projected_year, projection_status, rate_band, reached,
                       required_pace, yearly_change, years_to_target)
from .numeric import (percent, ratio, round_half_even, round_half_up, safe_double, safe_int,
                      safe_string)
