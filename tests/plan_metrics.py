"""Numbers of rows that the scans of a query give out, by the executed plan's metrics."""


def output_rows(df):
    plan = df._jdf.queryExecution().executedPlan()
    plan.execute().count()
    found, todo = [], [plan]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("Adaptive"):
            todo.append(node.executedPlan())
            continue
        if node.nodeName().startswith("Scan parquet"):
            found.append(node.metrics().apply("numOutputRows").value())
        for children in (node.children(), node.subqueries()):
            todo += [children.apply(i) for i in range(children.size())]
        if "QueryStage" in node.nodeName():
            todo.append(node.plan())
    return found
