"""Composed jobs, and the queries registered for checking, one module per family.

Every query module offers ``QUERIES`` (name -> callable(spark, folder)) and ``ORACLE`` (name -> SQL).
"""
