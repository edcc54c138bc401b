"""crowdscope: mobile-audience analytics as Spark DataFrame plans.

Every public function takes DataFrames (and plain parameters) and returns a
lazy DataFrame. Nothing is collected to the driver inside the library; all
segments, jobs and users are rows, so one plan serves any number of them.
"""

__version__ = "0.1.0"
