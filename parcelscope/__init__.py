"""parcelscope: land-use and quality-of-life analytics as Spark DataFrame operators.

Every operator is a plain function from DataFrame(s) and parameters to a
DataFrame (or a Column expression builder), so Catalyst sees the whole plan.
"""

from parcelscope.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
