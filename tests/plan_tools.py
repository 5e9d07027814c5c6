"""What a finished query read, from the metrics of its executed plan."""


def _children(node):
    name = node.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return [node.executedPlan()]
    if name.endswith("QueryStageExec"):
        return [node.plan()]
    if name.startswith("ReusedExchange"):
        return []  # counted where it is made
    kids, subs = node.children(), node.subqueries()
    return [kids.apply(i) for i in range(kids.size())] + [subs.apply(i).child() for i in range(subs.size()) if hasattr(subs.apply(i), "child")]


def nodes(df):
    """All operators of the executed plan of a DataFrame that has run."""
    todo, out = [df._jdf.queryExecution().executedPlan()], []
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(_children(node))
    return out


def metric(node, name):
    return node.metrics().apply(name).value()


def scans(df):
    """The file scans of a DataFrame that has run."""
    return [n for n in nodes(df) if n.getClass().getSimpleName() == "FileSourceScanExec"]


def count(df, name):
    """Operators of a kind in the executed plan, by class name."""
    return sum(n.getClass().getSimpleName() == name for n in nodes(df))
