"""Operators for preparing language-model training data at corpus scale.

Nothing outside this subpackage imports it.  Every operator accepts any
DataFrame that has the columns it names as parameters; further columns are
carried or ignored, never relied on.
"""
