"""visitlens: click-stream session, funnel, area and ad-click analytics on Spark DataFrames.

Every operator takes DataFrames (plus plain Python parameters) and returns a lazy
DataFrame; nothing is collected to the driver.
"""

from visitlens.session import get_spark

__all__ = ["get_spark"]
