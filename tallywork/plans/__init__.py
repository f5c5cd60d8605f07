from tallywork.plans import commerce, learning, rides, telecom
from tallywork.plans.pipeline import RunResult, build, register_views, run_domain, stage

DOMAINS = {"commerce": commerce, "rides": rides, "telecom": telecom, "learning": learning}

__all__ = [
    "DOMAINS", "RunResult", "build", "commerce", "learning", "register_views", "rides", "run_domain", "stage", "telecom",
]
