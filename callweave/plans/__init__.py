from callweave.plans.cross_reference import cross_reference, office_export, stats_export
from callweave.plans.daily import DayPaths, Reference, day_facts, rerun_cross_reference, run_day
from callweave.plans.ivr import ivr_prep
from callweave.plans.matching import match_calls
from callweave.plans.midnight import DayFiles, day_with_edges, own_rows
from callweave.plans.organisation import org_directory, user_directory
from callweave.plans.regression import regression_check
from callweave.plans.reruns import changed_days, day_index, write_index
from callweave.plans.rules import call_legs, call_rules
from callweave.plans.tariff import tariff_classify
from callweave.plans.tickets import ticket_prep

__all__ = [
    "DayFiles", "DayPaths", "Reference", "call_legs", "call_rules", "changed_days", "cross_reference", "day_facts", "day_index", "day_with_edges",
    "ivr_prep", "match_calls", "office_export", "org_directory", "own_rows", "regression_check",
    "rerun_cross_reference", "run_day", "stats_export", "tariff_classify", "ticket_prep", "user_directory",
    "write_index",
]
