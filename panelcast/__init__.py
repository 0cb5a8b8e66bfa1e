"""Forecasts for many time series at once, as Spark jobs."""

import sys

from pyspark import cloudpickle

# Code that runs in Python workers travels with its job, so the package need
# not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from panelcast.operators.models import Plugin, make_model, model_names  # noqa: E402
from panelcast.plans.pipeline import Workflow  # noqa: E402
from panelcast.spec import Cutoffs, PanelSpec, today_in  # noqa: E402

__all__ = ["Cutoffs", "PanelSpec", "Plugin", "Workflow", "make_model", "model_names", "today_in"]
