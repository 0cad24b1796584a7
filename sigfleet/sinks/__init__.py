"""Writers for result documents, reports and exports."""
