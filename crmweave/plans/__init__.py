"""Ready-made write and read plans per CRM, built from the operators."""
