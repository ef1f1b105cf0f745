"""Subscription analytics as Spark DataFrame jobs.

Raw customers, orders, courses and watch time become a star schema; each
month's subscription revenue is spread over the courses watched; recurring
revenue, royalties, status and consumption are reported from there.
"""

from watchledger.session import build_session
from watchledger.settings import Settings

__all__ = ["Settings", "build_session"]
