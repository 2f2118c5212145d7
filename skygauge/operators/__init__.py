"""DataFrame to DataFrame operators. They read nothing and write nothing by themselves."""
