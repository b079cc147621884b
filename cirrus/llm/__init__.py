"""Operators for preparing training text and vectors at corpus scale.

Nothing else in the library imports this subpackage.  ``queries`` binds each
operator to the driver's tables; the other modules are general operators that
take any DataFrame and column names.
"""
