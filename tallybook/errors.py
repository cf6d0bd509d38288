"""Errors a run can stop with. A finding is a row, never an exception."""


class TallybookError(RuntimeError):
    """Base class: the run cannot go on."""


class FormatDetectionError(TallybookError):
    """No configured encoding or delimiter reads a file."""


class MappingError(TallybookError):
    """Columns, synonyms, registry or proposals contradict the canonical schema."""


class ApprovalError(TallybookError):
    """An approval cannot be carried out as asked."""


class ControlTotalError(TallybookError):
    """Rows received differ from rows accepted plus rows quarantined."""


class ControlArithmeticError(TallybookError):
    """A control's two ways of measuring one quantity disagree."""


class ExpectationError(TallybookError):
    """A named expectation failed, so nothing may be written."""
