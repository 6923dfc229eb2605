"""Operators for preparing training text: ten DataFrame operators, their registered
queries (``queries``) and the SQL of those (``oracle``). Nothing outside this folder
imports it."""
