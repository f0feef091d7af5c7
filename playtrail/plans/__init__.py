from playtrail.plans.batch import run_batch
from playtrail.plans.live import start_live

__all__ = ["run_batch", "start_live"]
