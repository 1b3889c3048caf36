"""Writers for the consolidated table and the KPI report."""
