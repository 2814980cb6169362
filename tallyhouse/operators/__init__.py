"""Set-based cleaning, rule, eligibility, quality and lifecycle jobs."""
