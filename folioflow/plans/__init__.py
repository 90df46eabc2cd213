"""Dataset builders by name; importing the package registers all of them."""

from folioflow.plans import asset, factor, instruments, market_data, portfolio, scenario, trade_info  # noqa: F401
from folioflow.plans.build import BUILDERS, BuildContext, build_dataset, run_dataset

__all__ = ["BUILDERS", "BuildContext", "build_dataset", "run_dataset"]
